import sys

from vitrine.cli import main

main(sys.argv[1:])
