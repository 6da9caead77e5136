"""Set operators T1 to T6 and incremental state I1 to I5."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog, sidecars
from ..sources.catalogues import batch_folders
from ..streaming import cycles
from .registry import query
from .scalars import news_and_archive
from .windows import screen


@query("t1_candidate_union", """SELECT event_id, source, CASE WHEN source = 'dfo' THEN 'C' ELSE 'A' END AS tier,
  CASE WHEN source = 'groundsource' THEN n_indep END AS n_indep FROM fx_floods
  WHERE source = 'dfo' OR n_indep % 2 = 1 OR n_indep >= 2""")
def _(t):
    return catalog.tiered_union(*news_and_archive(t)).select("event_id", "source", "tier", "n_indep")


def earlier(t):
    """Events already sampled: those with a large order line."""
    ids = t.lineitem.filter("l_quantity > 40").select(F.col("l_orderkey").alias("ev")).distinct()
    return t.floods.join(ids, "ev", "left_semi")


def no_flood(t):
    ids = t.lineitem.filter("l_tax > 0.07").select(F.col("l_orderkey").alias("ev")).distinct()
    return t.floods.join(ids, "ev", "left_semi").select("event_id")


EARLIER = "SELECT event_id FROM fx_floods WHERE ev IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40)"
NO_FLOOD = "SELECT event_id FROM fx_floods WHERE ev IN (SELECT l_orderkey FROM lineitem WHERE l_tax > 0.07)"


@query("t2_append_union", f"""SELECT event_id, year FROM fx_floods WHERE event_id IN ({EARLIER})
  UNION ALL SELECT event_id, year FROM fx_floods WHERE n_indep = 2 AND event_id NOT IN ({EARLIER})""")
def _(t):
    return cycles.append_new(earlier(t).select("event_id", "year"), t.floods.filter("n_indep = 2"))


@query("t3_ledger_union", f"SELECT event_id FROM ({NO_FLOOD}) UNION SELECT event_id FROM fx_floods WHERE passed AND n_indep % 2 = 1")
def _(t):
    return cycles.grow_ledger(no_flood(t), cycles.definitive_misses(screen(t)))


@query("t4_skip_set", f"SELECT event_id FROM ({EARLIER}) UNION SELECT event_id FROM ({NO_FLOOD})")
def _(t):
    return cycles.grow_ledger(earlier(t), no_flood(t))


@query("t5_batch_union", """SELECT 'b' || LPAD(CAST(l_linenumber AS STRING), 2, '0') AS batch, COUNT(*) AS n FROM lineitem WHERE l_quantity <= 49 GROUP BY 1""")
def _(t):
    named = F.when(F.col("l_quantity") > 49, "notes").otherwise(F.concat(F.lit("batch_"), F.col("l_linenumber").cast("string")))
    return batch_folders(t.lineitem.withColumn("batch_name", named)).groupBy("batch").agg(F.count("*").alias("n"))


@query("t6_cycle_rows", f"SELECT event_id, pos FROM fx_floods WHERE event_id IN ({EARLIER}) ORDER BY pos")
def _(t):
    return cycles.cycle_rows(t.floods, earlier(t)).select("event_id", "pos")


@query("i1_append_cycle", f"""SELECT 'open' AS part, event_id FROM fx_floods WHERE event_id NOT IN ({EARLIER}) AND event_id NOT IN ({NO_FLOOD})
  UNION ALL SELECT 'manifest', event_id FROM ({EARLIER}) UNION ALL SELECT 'manifest', event_id FROM fx_floods
    WHERE passed AND n_indep % 2 = 0 AND event_id NOT IN ({EARLIER})
  UNION ALL SELECT 'ledger', event_id FROM (SELECT event_id FROM ({NO_FLOOD}) UNION SELECT event_id FROM fx_floods WHERE passed AND n_indep % 2 = 1)""")
def _(t):
    log = screen(t)
    parts = cycles.append_cycle(
        t.floods.select("event_id"), earlier(t).select("event_id"), no_flood(t), log, log.filter("passed").select("event_id"))
    named = [df.select(F.lit(name).alias("part"), "event_id") for name, df in zip(("open", "manifest", "ledger"), parts)]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("i2_seeded_cycle", f"""SELECT event_id FROM ({EARLIER}) UNION ALL SELECT event_id FROM fx_floods WHERE n_indep = 3 AND event_id NOT IN ({EARLIER})""")
def _(t):
    manifest = cycles.seed_manifest(None, earlier(t).select("event_id"))
    return cycles.append_new(manifest, t.floods.filter("n_indep = 3").select("event_id"))


@query("i3_done_markers", """SELECT event_id, COALESCE(n, 0) AS n_chips FROM fx_floods LEFT JOIN
  (SELECT l_orderkey AS ev, COUNT(*) AS n FROM lineitem WHERE l_quantity > 25 GROUP BY 1) USING (ev)""")
def _(t):
    chips = t.lineitem.filter("l_quantity > 25").select(F.col("l_orderkey").alias("ev")).join(
        t.floods.select("ev", "event_id"), "ev")
    return cycles.mark_done(t.floods, chips)


@query("i4_definitive_outcomes", "SELECT event_id FROM fx_floods WHERE passed AND n_indep % 2 = 1")
def _(t):
    full = catalog.screen_with(t.floods, lambda _: screen(t))
    return cycles.definitive_misses(full)


@query("i5_idempotent_patch", """SELECT CAST(o_orderkey AS STRING) AS chip_id, CASE WHEN n IS NOT NULL THEN CAST(n AS STRING) END AS qc,
  n IS NULL AS todo FROM orders LEFT JOIN (SELECT l_orderkey AS k, COUNT(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY 1) ON k = o_orderkey""")
def _(t):
    docs = t.orders.select(F.col("o_orderkey").cast("string").alias("chip_id"))
    blocks = t.lineitem.filter("l_quantity > 10").groupBy(F.col("l_orderkey").cast("string").alias("chip_id")).agg(
        F.count("*").cast("string").alias("qc"))
    once = sidecars.patch_block(docs, blocks, "qc")
    twice = sidecars.patch_block(once, blocks, "qc")
    todo = sidecars.still_to_do(twice, "qc").select("chip_id", F.lit(True).alias("todo"))
    return twice.join(todo, "chip_id", "left").withColumn("todo", F.coalesce("todo", F.lit(False)))
