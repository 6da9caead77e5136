"""Document fingerprints by winnowing (Schleimer, Wilkerson and Aiken 2003). DataFrame functions only.

Every run of ``GRAM`` code points is hashed, the smallest hash of every ``WINDOW`` neighbouring runs is
picked, the rightmost of equal ones, and the picks with their positions are the fingerprint. Two texts that
share GRAM + WINDOW - 1 consecutive code points share a pick.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..operators.ranking import ranked
from ..session import cut_lineage
from .common import broadcast_if, register, table

GRAM, WINDOW = 8, 16
#: A pick is one long: the complement of a 32-bit hash above a 31-bit place, so that the largest
#: value is the smallest hash, and the rightmost of equal ones. The place is that of the run's first byte, from 1.
PLACES = 1 << 31
HASHES = 1 << 32
DOCS_PER_CELL = 512
BROADCAST_GUESTS = 500_000


def with_picks(df: DataFrame, text: str, name: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``df`` with ``name``: the picks of column ``text`` by position. ``window`` is a power of two.

    A text shorter than ``gram`` is one run; fewer runs than ``window`` are one window; an empty
    text has no picks.
    """
    runs = F.greatest(F.length(text) - (gram - 1), F.lit(1))
    df = df.withColumn("_runs", F.when(F.length(text) > 0, runs).otherwise(0))

    def values(codes: Column) -> Column:  # a lambda variable: a column would be copied for every run
        def value(place):
            run = F.substring(codes, place, F.lit(4 * gram))
            return F.xxhash64(run).bitwiseAND(F.lit((HASHES - 1) * PLACES)) + place
        return F.transform(F.sequence(F.lit(1), F.col("_runs") * 4 - 3, F.lit(4)), value)

    # code points of four bytes each, so that a run is a slice at a known place
    codes = F.array(F.encode(text, "UTF-32"))
    df = df.withColumn("_best", F.when(F.col("_runs") > 0, F.transform(codes, values)[0]).otherwise(F.array().cast("array<bigint>")))
    reach = 1
    while reach < window:  # best of 2, 4, ... runs from each place on; shorter at the end
        df = df.withColumn("_best", F.zip_with(
            "_best", F.slice("_best", F.lit(reach + 1), F.greatest(F.col("_runs"), F.lit(1))), lambda a, b: F.greatest(a, b)))
        reach *= 2
    whole = F.greatest(F.col("_runs") - (window - 1), F.lit(1))
    return df.withColumn(name, F.array_distinct(F.slice("_best", F.lit(1), whole))).drop("_runs", "_best")


def as_text(picks: Column) -> Column:
    """``hash@position`` (hexadecimal, decimal) of every pick, comma-joined."""
    one = lambda v: F.concat(
        F.lower(F.hex(F.lit(HASHES - 1) - F.shiftright(v, 31))), F.lit("@"),
        F.shiftright(v.bitwiseAND(F.lit(PLACES - 1)) - 1, 2).cast("string"))
    return F.concat_ws(",", F.transform(picks, one))


def likeness(a: Column, b: Column) -> Column:
    """Shared share of the distinct hashes of two lists of picks; 1 for two empty ones."""
    hashes = lambda picks: F.array_distinct(F.transform(picks, lambda v: F.shiftright(v, 31)))
    both = F.size(F.array_intersect(hashes(a), hashes(b)))
    total = F.size(hashes(a)) + F.size(hashes(b)) - both
    return F.when(total == 0, 1.0).otherwise(both / total)


def in_cells(docs: DataFrame, per_cell: int = DOCS_PER_CELL) -> DataFrame:
    """``docs`` (doc_id, text) with ``cell``, ``guest``, ``place``: blocks of neighbouring doc_ids, in which the
    first document of the next block (after the last: of the first) is a guest at the end.

    Blocks have equal width, narrowed until the fullest holds a few times ``per_cell`` documents.
    """
    place = F.col("doc_id").cast("long")
    low, high, n = docs.agg(F.min(place), F.max(place), F.count("*")).first()
    low = 0 if low is None else low - 1  # null doc_ids come first
    place = F.coalesce(place, F.lit(low))
    width = max(1, -(-((high or 0) - low + 1) * per_cell // max(n, 1)))
    cell = lambda: F.floor((F.col("place") - low) / width)
    ids = docs.select(place.alias("place"))
    while width > 1:
        fullest = ids.groupBy(cell().alias("cell")).count().agg(F.max("count")).first()[0]
        if (fullest or 0) <= 4 * per_cell:
            break
        width = max(1, width // 8)
    heads = cut_lineage(ranked(ids.groupBy(cell().alias("cell")).agg(F.min("place").alias("head")), [], ["cell"]))
    before = heads.select(F.col("cell").alias("guest_of"), (F.col("rank") + 1).alias("rank"))
    last = heads.count()
    before = before.withColumn("rank", F.when(F.col("rank") > last, F.lit(1)).otherwise(F.col("rank")))
    guests = heads.join(before, "rank").select(F.col("head").alias("place"), "guest_of")
    own = docs.select("doc_id", "text", place.alias("place")).select("*", cell().alias("cell"), F.lit(False).alias("guest"))
    visiting = docs.select("doc_id", "text", place.alias("place")).join(broadcast_if(cut_lineage(guests), BROADCAST_GUESTS), "place").select(
        "doc_id", "text", "place", F.col("guest_of").alias("cell"), F.lit(True).alias("guest"))
    return own.unionByName(visiting)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_text, picks, edited_picks, near_edited, near_next.

    The next document is that of the next larger doc_id (equal ones by text), after the last the
    first; the edited text has the last floor(n_chars / 2) code points replaced by the next one's
    first as many. A null text is empty, a null doc_id comes first, repeated rows each give a row, a
    single row is its own next one.
    """
    placed = in_cells(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).repartition("cell")
    order = W.partitionBy("cell").orderBy("guest", "place", "text")
    pairs = with_picks(placed, "text", "picks").select(
        "doc_id", "text", "picks", "guest", F.lead("text").over(order).alias("next_text"), F.lead("picks").over(order).alias("next_picks"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    own = pairs.filter(~F.col("guest")).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited_text"), "picks",
        likeness(F.col("picks"), F.col("next_picks")).alias("near_next"))
    return with_picks(own, "edited_text", "edited_picks").withColumn(
        "near_edited", likeness(F.col("picks"), F.col("edited_picks")))


@register("op4_winnowing")
def op4_winnowing(spark, folder):
    return fingerprints(table(spark, folder, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), as_text(F.col("picks")).alias("fingerprint"),
        as_text(F.col("edited_picks")).alias("edited_fingerprint"), "near_edited", "near_next")
