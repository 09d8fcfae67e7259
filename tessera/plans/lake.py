"""Silver and Gold as versioned tables, and their incremental refresh.

``build_lake`` writes a first version; ``refresh`` applies batches of raw rows
to the next one:

1. Silver upsert: only the key buckets that the batch touches are read and
   rewritten; the latest version of a key wins, as in a full rebuild;
2. dimensions of changed customers, sellers and products: the same buckets;
3. touched orders: those of the changed rows, and for changed customers,
   sellers and products the orders that refer to them;
4. facts: rows of touched orders leave the partitions that hold them (found by
   the fact's zone map, so other files are not even scanned) and enter those
   they belong to now, recomputed from the touched buckets alone;
5. checks on what was written, then one publication for all tables.

So the work follows the batch, partitions without touched orders keep their
files, and a row whose key or partition value is NULL is handled like any
other. The result equals a full rebuild.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import star as K
from ..operators.dedupe import dedupe_latest
from ..operators.incremental import affected_files, zone_map
from ..operators.silver import conform
from ..operators.taxonomy import enrich_taxonomy
from ..session import released_shuffles, scratch_path
from ..sources.io import CODEC, write_bucketed
from ..sources.schemas import SILVER_SPECS
from ..sources.versions import BUCKET, Change, Lake, bucketed, folder_column, folder_names, run_column

# what a table is bucketed by: everything about an order lies in buckets of one number
BUCKET_KEYS = {"customers": "customer_id", "sellers": "seller_id", "products": "product_id", "orders": "order_id",
               "order_items": "order_id", "order_payments": "order_id", "order_reviews": "order_id"}
DIMENSIONS = {"customers": ("dim_customer", K.dim_customer), "sellers": ("dim_seller", K.dim_seller),
              "products": ("dim_product", K.dim_product)}
GRAINS = {"fact_order_item": ("order_id", "order_item_id"), "fact_payment": ("order_id", "payment_sequential"),
          "fact_review": ("review_id", "order_id", "product_key")}
FACT_KEYS = {"fact_order_item": ("customer_key", "seller_key", "product_key"), "fact_payment": ("customer_key",),
             "fact_review": ("customer_key", "product_key")}
KEY_HOMES = {"customer_key": "dim_customer", "seller_key": "dim_seller", "product_key": "dim_product"}
# facts whose rows depend on a Silver table
READS = {
    "customers": ("fact_order_item", "fact_payment", "fact_review"), "sellers": ("fact_order_item",),
    "products": ("fact_order_item", "fact_review"), "orders": ("fact_order_item", "fact_payment", "fact_review"),
    "order_items": ("fact_order_item", "fact_review"), "order_payments": ("fact_payment",), "order_reviews": ("fact_review",),
}
# where the orders that refer to a changed customer, seller or product are found
REFERRERS = {"customers": "orders", "sellers": "order_items", "products": "order_items"}

LatestBy = Mapping[str, Sequence[str]]


def _together(jobs: Sequence[Callable], at_once: int = 4) -> list:
    """Independent writes as concurrent Spark jobs."""
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(jobs)))) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def _order_columns(raw: DataFrame, name: str, latest_by: LatestBy) -> list[str]:
    return [c for c in latest_by.get(name, SILVER_SPECS[name].latest_by) if c in raw.columns]


def silver_versions(raw: DataFrame, name: str, latest_by: LatestBy, dealt: tuple[int, str] | None = None) -> DataFrame:
    """Conformed rows, the latest of each key, with the columns that tell which is the latest (``dealt`` out before that)."""
    spec, order = SILVER_SPECS[name], _order_columns(raw, name, latest_by)
    outs = {c.out for c in spec.columns}
    rows = conform(raw, spec, keep=[c for c in order if c not in outs])
    return dedupe_latest(rows.repartition(*dealt) if dealt else rows, spec.keys, order)


def _dealt_by(name: str, order_buckets: int | None) -> tuple[int, str] | None:
    """How a table about orders is dealt out where the lake has ``order_buckets``."""
    return (order_buckets, "order_id") if order_buckets and BUCKET_KEYS[name] == "order_id" else None


def _enriched(rows: DataFrame, name: str, taxonomy: DataFrame) -> DataFrame:
    if name != "products":
        return rows
    bare = rows.drop("normalized_category", "category_family")
    return enrich_taxonomy(bare, taxonomy, "product_category_name").select(
        *bare.columns, "normalized_category", "category_family")


def silver(change: Change, name: str, folders: Sequence[str] | None = None) -> DataFrame:
    """A Silver table of the lake (or some of its buckets) as the star's builders take it."""
    rows = change.lake.dealt(change.entries[f"silver_{name}"]) if folders is None else None
    rows = change.read(f"silver_{name}", folders) if rows is None else rows
    outs = [c.out for c in SILVER_SPECS[name].columns if c.out in rows.columns]
    more = ["normalized_category", "category_family"] if name == "products" else []
    return rows.select(*outs, *more)


def _dimensions(change: Change) -> dict[str, DataFrame]:
    return {name: change.read(name).drop(BUCKET) for name, _ in DIMENSIONS.values()}


def _all_orders(change: Change, dims: dict[str, DataFrame], order_buckets: int | None) -> tuple[Callable[[str], DataFrame], bool]:
    """What ``_fact`` reads for all orders, and whether it lies by order.

    If it does, the orders are kept aside with their customer's key, and, where
    the products cannot be broadcast, the orders' products with theirs, once for all facts.
    """
    names = ("orders", "order_items", "order_payments", "order_reviews")
    if not order_buckets or not all(change.lake.dealt(change.entries[f"silver_{n}"]) for n in names):
        return lambda n: silver(change, n), False
    aside = {"orders": K.keyed_orders(silver(change, "orders"), dims["dim_customer"], order_buckets)}
    if change.lake.input_bytes(dims["dim_product"]) > change.lake.broadcast_limit():
        aside[PRODUCTS] = K.products_of_orders(silver(change, "order_items"), dims["dim_product"], order_buckets)

    def keep(rows: DataFrame) -> DataFrame:
        path = scratch_path(change.lake.spark, "by-order")
        table = "tessera_" + path.rsplit("/", 1)[-1].replace("-", "_")
        change.aside[table] = path
        return write_bucketed(rows, path, table, ["order_id"], order_buckets, placed=True)

    kept = dict(zip(aside, _together([lambda rows=rows: keep(rows) for rows in aside.values()])))
    return lambda n: kept.get(n) if n in ("orders", PRODUCTS) else silver(change, n), True


PRODUCTS = "order_products"


def _fact(name: str, change: Change, dims: dict[str, DataFrame], read: Callable[[str], DataFrame], dealt: bool = False) -> DataFrame:
    products = read(PRODUCTS) if dealt else None
    if name == "fact_order_item":
        return K.fact_order_item(read("orders"), read("order_items"), dims["dim_customer"], dims["dim_seller"], dims["dim_product"],
                                 products)
    if name == "fact_payment":
        return K.fact_payment(read("order_payments"), read("orders"), dims["dim_customer"])
    return K.fact_review(read("order_reviews"), read("orders"), read("order_items"), dims["dim_customer"], dims["dim_product"],
                         dealt, products)


def _write_whole(fact: str, change: Change, dims: dict[str, DataFrame], read: Callable[[str], DataFrame], dealt: bool) -> None:
    """Write all rows of a fact. What lies by order goes into the few folders of the years without another shuffle."""
    change.write(fact, _fact(fact, change, dims, read, dealt), K.PARTITIONS[fact], placed=dealt and fact in K.BY_YEAR)


def _write_zones(change: Change, fact: str, buckets: int) -> None:
    """Add the zone map of the runs that this change wrote of a fact to the table ``zones_<fact>``."""
    entry, known = change.entries[fact], change.base.entries.get(fact)
    before = {r for ids in known.parts.values() for r in ids} if known else set()
    parts = [(r, f) for f, ids in entry.parts.items() for r in ids if r not in before]
    if parts:
        rows = change.lake.read_runs(fact, entry, parts, extra=[F.col("_metadata.file_path").alias("_file")])
    else:
        rows = change.read(fact, []).withColumn("_file", F.lit(""))
    zones = zone_map(rows, "order_id", ["_file"], buckets)
    if f"zones_{fact}" in change.entries:
        if parts:
            change.append(f"zones_{fact}", zones)
    else:
        change.write(f"zones_{fact}", zones)


def build_lake(spark: SparkSession, raw: Mapping[str, DataFrame], taxonomy: DataFrame, root: str,
               latest_by: LatestBy | None = None, buckets: int = 64, order_buckets: int | None = None) -> Lake:
    """Version 1 of a lake: Silver by key bucket, dimensions, facts by their partitions, zone maps.

    ``order_buckets``: the tables about orders are dealt out by order_id into so
    many parts before their dedupe and written as they lie, which is their only
    shuffle; this session's facts join them without one. A part holds all rows
    of its orders: leave it unset where one order holds a large share of them.
    """
    lake, latest_by = Lake(spark, root), latest_by or {}
    change = lake.begin()
    names = [n for n in BUCKET_KEYS if n in raw]

    def write_silver(name):
        dealt = _dealt_by(name, order_buckets)
        rows = _enriched(silver_versions(raw[name], name, latest_by, dealt), name, taxonomy)
        change.write(f"silver_{name}", bucketed(rows, [BUCKET_KEYS[name]], buckets), [BUCKET], dealt=dealt)

    with released_shuffles(spark):
        _together([lambda n=n: write_silver(n) for n in names])
        _together([*(lambda n=n: change.write(DIMENSIONS[n][0], bucketed(DIMENSIONS[n][1](silver(change, n)), [BUCKET_KEYS[n]], buckets),
                                              [BUCKET]) for n in DIMENSIONS),
                   lambda: change.write("dim_date", K.dim_date(silver(change, "orders"), silver(change, "order_reviews")))])
        dims = _dimensions(change)
        read, dealt = _all_orders(change, dims, order_buckets)

        def write_fact(fact):
            _write_whole(fact, change, dims, read, dealt)
            _write_zones(change, fact, buckets)

        _together([lambda f=f: write_fact(f) for f in GRAINS])
    change.publish(buckets=buckets, order_buckets=order_buckets)
    return lake


def upsert(change: Change, name: str, raw: DataFrame, taxonomy: DataFrame, latest_by: LatestBy, buckets: int) -> tuple[DataFrame, list[str]]:
    """Apply raw rows to a Silver table; returns (the batch as written aside, the buckets it touches).

    A batch that can be broadcast leaves the rows that it does not replace
    where they lie. A larger one, for a table that is dealt out by order, is
    put together with the rows of its orders: one shuffle of both, by order_id,
    while rows of other orders stay in their part.
    """
    spec, order, table = SILVER_SPECS[name], _order_columns(raw, name, latest_by), f"silver_{name}"
    spark = change.lake.spark
    path = scratch_path(spark, f"batch-{name}")
    rows = bucketed(silver_versions(raw, name, latest_by), [BUCKET_KEYS[name]], buckets)
    rows.write.partitionBy(BUCKET).option("compression", CODEC).parquet(path)
    batch = spark.read.schema(rows.schema).parquet(path)
    folders = [n for n in change.lake.files.names(path, folders_only=True) if n.startswith(f"{BUCKET}=")]
    if not folders:
        return batch, []
    current = change.read(table, folders)
    small = change.lake.input_bytes(batch) <= change.lake.broadcast_limit()
    dealt = _dealt_by(name, None if small else change.base.notes.get("order_buckets"))
    arriving = F.broadcast(batch) if small else batch
    same = [current[k].eqNullSafe(batch[k]) for k in spec.keys]
    missing = [F.lit(None).cast(current.schema[c].dataType).alias(c) for c in current.columns if c not in batch.columns]
    lacking = [F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in batch.columns if c not in current.columns]
    arrived = batch.select("*", *missing, F.lit(1).alias("_src"))
    lies = change.lake.dealt(change.entries[table]) if dealt else None
    if lies is not None:
        replaced, left = _by_order(lies.where(F.col(BUCKET).isin([int(f.split("=")[1]) for f in folders])), batch, *dealt)
    elif dealt:
        replaced, left = current, None
    else:
        replaced, left = (current.join(arriving, same, how) for how in ("left_semi", "left_anti"))
    replaced = replaced.select("*", *lacking, F.lit(0).alias("_src"))
    # rows without an order of their own are replaced by what arrives
    decide = order if all(c in current.columns for c in order) and order else [*order, "_src"]
    both = replaced.unionByName(arrived)
    latest = dedupe_latest(both.repartition(*dealt) if dealt else both, spec.keys, decide).drop("_src")
    winners = _enriched(latest, name, taxonomy).select(*current.columns)
    change.rewrite(table, folders, winners if left is None else left.unionByName(winners), placed=small, dealt=dealt)
    return batch, folders


def _by_order(rows: DataFrame, batch: DataFrame, parts: int, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the batch's orders, the others) of rows that lie by ``key`` in so many parts; only the batch's keys are dealt out.

    Rows without a key go with the first.
    """
    keyed, keys = rows.where(F.col(key).isNotNull()), batch.select(key).repartition(parts, key).distinct().hint("shuffle_hash")
    return (keyed.join(keys, key, "left_semi").unionByName(rows.where(F.col(key).isNull())), keyed.join(keys, key, "left_anti"))


def _touched(change: Change, done: Mapping[str, tuple[DataFrame, list[str]]], buckets: int) -> tuple[DataFrame, list[str]]:
    """Distinct order ids (with their bucket) whose fact rows the batches can change, and their buckets' folders."""
    if len(done) == 1 and not set(done) & set(REFERRERS):  # the batch itself tells, and lies by order already
        (batch, folders), = done.values()
        return batch.select("order_id", BUCKET).distinct(), folders
    ids = []
    for name, (batch, _) in done.items():
        if name in REFERRERS:
            key, home = BUCKET_KEYS[name], silver(change, REFERRERS[name])
            ids.append(home.select("order_id", key).join(batch.select(key), key, "left_semi").select("order_id"))
        else:
            ids.append(batch.select("order_id"))
    return _staged_orders(change, Q.union_all(ids), buckets)


def refresh(lake: Lake, batches: Mapping[str, DataFrame], taxonomy: DataFrame, latest_by: LatestBy | None = None,
            **notes) -> int:
    """Apply batches of raw rows (data set -> rows) and publish the next version; returns its number.

    Raises QualityGateError, and publishes nothing, if the rows written fail
    their checks (grain, foreign keys). ``notes`` are stored with the version.
    """
    change, latest_by = lake.begin(), latest_by or {}
    buckets = change.base.notes["buckets"]
    with released_shuffles(lake.spark):
        done = dict(zip(batches, _together([
            lambda n=n, raw=raw: upsert(change, n, raw, taxonomy, latest_by, buckets) for n, raw in batches.items()])))
        done = {name: (rows, folders) for name, (rows, folders) in done.items() if folders}
        if done:
            _refresh_gold(change, done, buckets)
    return change.publish(**notes)


def refresh_orders(lake: Lake, orders: DataFrame, **notes) -> int:
    """Recompute the fact rows of the given orders (column ``order_id``) and publish, e.g. for a backfill."""
    change = lake.begin()
    buckets = change.base.notes["buckets"]
    with released_shuffles(lake.spark):
        rewrite_facts(change, *_staged_orders(change, orders.select("order_id"), buckets), tuple(GRAINS), buckets)
    return change.publish(**notes)


def _staged_orders(change: Change, orders: DataFrame, buckets: int) -> tuple[DataFrame, list[str]]:
    """Distinct order ids with their bucket, written aside, and the bucket folders they lie in."""
    path = scratch_path(change.lake.spark, "touched-orders")
    ids = bucketed(orders.distinct(), ["order_id"], buckets)
    ids.write.partitionBy(BUCKET).option("compression", CODEC).parquet(path)
    folders = [n for n in change.lake.files.names(path, folders_only=True) if n.startswith(f"{BUCKET}=")]
    return change.lake.spark.read.schema(ids.schema).parquet(path), folders


def _refresh_gold(change: Change, done: Mapping[str, tuple[DataFrame, list[str]]], buckets: int) -> None:
    def dimension(name):
        table, build = DIMENSIONS[name]
        folders = done[name][1]
        change.rewrite(table, folders, bucketed(build(silver(change, name, folders)), [BUCKET_KEYS[name]], buckets), placed=True)

    jobs = [lambda n=n: dimension(n) for n in DIMENSIONS if n in done]
    if {"orders", "order_reviews"} & set(done):
        jobs.append(lambda: change.write("dim_date", K.dim_date(silver(change, "orders"), silver(change, "order_reviews"))))
    if jobs:
        _together(jobs)
    facts = [f for f in GRAINS if any(f in READS[n] for n in done)]
    rewrite_facts(change, *_touched(change, done, buckets), facts, buckets)


def rewrite_facts(change: Change, touched: DataFrame, folders: Sequence[str], facts: Sequence[str], buckets: int) -> None:
    """Replace the rows of touched orders (in bucket ``folders``) in the facts by rows recomputed from Silver, and check them.

    Where the orders are too many to be broadcast, and the folders that can hold
    them are most of a fact, taking their rows out would shuffle most of it, and
    twice; such a fact is written anew.
    """
    if not folders:
        return
    dims = _dimensions(change)
    small = change.lake.input_bytes(touched) <= change.lake.broadcast_limit()

    def of_touched(name: str) -> DataFrame:
        rows = silver(change, name, folders)
        return rows.join(touched, rows["order_id"].eqNullSafe(touched["order_id"]), "left_semi")

    def holders(fact: str) -> list[str]:
        live = sorted({r for ids in change.entries[fact].parts.values() for r in ids})  # as many as the manifest lists
        zones = change.read(f"zones_{fact}").where(run_column(F.col("_file")).isin(live))
        near = affected_files(zones, touched, "order_id", ["_file"], buckets)
        return folder_names(near.select(folder_column(F.col("_file"))))

    among = dict(zip(facts, _together([lambda f=f: holders(f) for f in facts])))
    whole = [] if small else [f for f in facts if 2 * change.bytes(f, among[f]) > change.bytes(f)]
    facts = [f for f in facts if f not in whole]
    read, dealt = _all_orders(change, dims, change.base.notes.get("order_buckets")) if whole else (None, False)

    def check(fact: str, fresh: DataFrame) -> None:
        Q.assert_passed(Q.union_all([
            Q.grain_rule(fresh, list(GRAINS[fact]), f"{fact}: refreshed rows have one row a key"),
            Q.ri_rules(fresh, [(f"{fact}: refreshed {key} values exist", key, dims[KEY_HOMES[key]], key) for key in FACT_KEYS[fact]])]))

    def anew(fact: str) -> None:
        _write_whole(fact, change, dims, read, dealt)
        check(fact, change.read(fact))
        _write_zones(change, fact, buckets)

    def leave(fact: str) -> None:
        change.remove(fact, touched, ["order_id"], among[fact])

    def enter(fact: str) -> tuple[str, list[str]]:
        entry = change.entries[fact]
        fresh_rows = _fact(fact, change, dims, of_touched).select(*entry.struct.fieldNames())
        run, made = change.lake.write_run(fact, fresh_rows, entry.by)
        check(fact, change.lake.read_runs(fact, entry, [(run, f) for f in made]))
        return run, made

    def list_runs(fact: str, run: str, made: list[str]) -> None:
        change.add_run(fact, run, made)
        _write_zones(change, fact, buckets)

    # old rows leave while the new ones are written and checked beside them
    done = _together([*(lambda f=f: leave(f) for f in facts), *(lambda f=f: enter(f) for f in facts),
                      *(lambda f=f: anew(f) for f in whole)], 2 * len(GRAINS))
    _together([lambda f=f, r=r: list_runs(f, *r) for f, r in zip(facts, done[len(facts):])])
