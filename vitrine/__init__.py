"""vitrine: e-commerce event analytics on Spark.

Entry points: ``vitrine.plans.queries.QUERIES`` (registered queries),
``vitrine.plans.batch_etl.run_daily_etl`` (daily ETL),
``vitrine.streaming.event_time.EventTimeJob`` (exact event-time stream),
``vitrine.streaming.landing`` (raw landing, fan-out), ``python -m vitrine``.
"""
