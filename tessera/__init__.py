"""tessera: a Spark-native medallion / star-schema analytics library.

Raw files land in Bronze with batch metadata, are typed, cleaned and
deduplicated into Silver (latest version wins), enriched through a category
taxonomy, modelled into a Gold star schema, checked by declarative data-quality
rules and queried by analytical operators. Every operator takes and returns
Spark DataFrames; nothing is collected to the driver.

Main entry points:

* ``plans.pipeline.csv_pipeline`` — raw CSV files to a gated, published Gold
  star in one call; ``plans.publish.publish_gold`` / ``stage_layers`` for
  Silver tables from any source;
* ``operators.silver`` / ``operators.star`` — Silver builders, dimensions, facts;
* ``operators.quality`` — rules, the 16-check report, the gate;
* ``operators.analytics`` (and ``plans.sql_views`` for SQL) — the five analyses;
* ``operators.profile``, ``operators.validation``, ``operators.marts``;
* ``operators.incremental``, ``plans.lake``, ``sources.versions``, ``streaming.*`` — incremental
  and streaming processing;
* ``python -m tessera`` — command line (publish, publish-csv, report, query,
  explain, list).
"""

__version__ = "0.1.0"
