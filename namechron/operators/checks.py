"""Self-checks of the tables: keys, alphabetical order, register, contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sort_key, trim_u
from ..schemas import Reason
from .ranks import running


def _numeric(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).cast("string").rlike(r"^\p{Nd}+$")).select(F.col(key).cast("long").alias("n"))


#: Numbers of a bitmap, and most numbers of a piece of a gap.
BITMAP, PIECE = 1 << 15, 1 << 16


def _bitmaps(df: DataFrame, key: str) -> DataFrame:
    """bucket, its numbers as a bitmap and their distinct count, least, largest and count with repeats; 4 KB a bucket, combined before the shuffle."""
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")
    found = _numeric(df, key).groupBy(F.bitmap_bucket_number("n").alias("bucket")).agg(bits, F.min("n").alias("low"), F.max("n").alias("high"), F.count(F.lit(1)).alias("rows"))
    return found.withColumn("distinct", F.bitmap_count("bits"))


def key_stats(df: DataFrame, key: str = "schl_nr") -> DataFrame:
    """One row: smallest, largest and count of numeric keys, gaps between them and repeated keys."""
    own = _bitmaps(df, key).agg(F.min("low").alias("kleinste"), F.max("high").alias("groesste"), F.coalesce(F.sum("rows"), F.lit(0)).alias("anzahl"), F.sum("distinct").alias("_distinct"))
    twice = key_duplicates(df, key).agg(F.count(F.lit(1)).alias("dubletten"))
    return own.crossJoin(F.broadcast(twice)).select("kleinste", "groesste", "anzahl", (F.col("groesste") - F.col("kleinste") + 1 - F.col("_distinct")).alias("luecken"), "dubletten")


#: The places of a bitmap's ones; a byte's hexadecimal digits hold its upper four bits first.
_ONES = """transform(array(transform(split(hex(bits), ''), c -> instr('0123456789ABCDEF', c) - 1)),
  v -> filter(sequence(0, 32767), p -> shiftright(v[int(2 * (p div 8) + if(p % 8 < 4, 1, 0))], p % 4) & 1 = 1))[0]"""


def key_gap_intervals(df: DataFrame, key: str = "schl_nr") -> DataFrame:
    """von and bis of each run of numbers between the smallest and the largest key that no row has.

    Runs within a bucket come from its bitmap, those between buckets from the least key of the next one;
    a run across buckets is one row, whatever its length.
    """
    buckets = running(_bitmaps(df, key), [], [F.floor(F.col("bucket") / BITMAP)], ["bucket"], {"next": (F.min, F.col("low"), F.least)}, falling=True)
    first = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * BITMAP + 1).otherwise(F.lit(0))
    sparse = buckets.where("distinct < high - low + 1").select(first.alias("first"), F.expr(_ONES).alias("ones"))
    after = F.transform("ones", lambda p, i: F.struct((F.col("first") + p + 1).alias("von"), (F.col("first") + F.get("ones", i + 1) - 1).alias("bis")))
    inside = sparse.select(F.explode(F.filter(after, lambda x: x["bis"] >= x["von"])).alias("x")).select("x.*")
    return inside.unionByName(buckets.where("next > high + 1").select((F.col("high") + 1).alias("von"), (F.col("next") - 1).alias("bis")))


def key_gaps(df: DataFrame, key: str = "schl_nr") -> DataFrame:
    """Numbers between the smallest and the largest key that no row has, written out in pieces of bounded length."""

    def cut(runs: DataFrame, length: int) -> DataFrame:
        begin = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bis") - F.col("von")) / length)), lambda i: F.col("von") + i * length))
        return runs.select("bis", begin.alias("von")).select("von", F.least("bis", F.col("von") + (length - 1)).alias("bis"))

    return cut(cut(key_gap_intervals(df, key), PIECE << 16), PIECE).select(F.explode(F.sequence("von", "bis")).alias("luecke"))


def key_duplicates(df: DataFrame, key: str = "schl_nr") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("anzahl")).where("anzahl > 1")


def flag_duplicates(streets: DataFrame, key: str = "schl_nr") -> DataFrame:
    """``streets`` with ``mehrfach``: whether another row has the key. The counts join back, so a hot key can be split."""
    return streets.join(key_duplicates(streets, key).select(key, F.lit(True).alias("_twice")), key, "left").withColumn("mehrfach", F.coalesce("_twice", F.lit(False))).drop("_twice")


def alphabet_dips(streets: DataFrame, lemma: str = "lemma", seq: str = "seq", rows_in_block: int = 100_000) -> DataFrame:
    """Rows whose sort key is below both neighbours in ``seq`` order while these are in order themselves.

    ``seq`` is an integer. Blocks of ``seq`` are sorted on their own; each hands its first and last
    two rows to its neighbours, so no window spans the whole table.
    """
    keyed = streets.withColumns({"_key": sort_key(lemma), "_block": F.floor(F.col(seq) / rows_in_block)})
    order = Window.partitionBy("_block").orderBy(seq)
    inner = keyed.withColumns({"_before": F.lag("_key").over(order), "_after": F.lead("_key").over(order)})
    ends = keyed.groupBy("_block").agg(F.min_by("_key", seq).alias("first"), F.max_by("_key", seq).alias("last"))
    around = Window.orderBy("_block")  # one row for each block of 100,000
    ends = ends.select("_block", F.lag("last").over(around).alias("_left"), F.lead("first").over(around).alias("_right"))
    full = inner.join(ends, "_block").withColumns({"_before": F.coalesce("_before", "_left"), "_after": F.coalesce("_after", "_right")})
    dip = (F.col("_key") < F.col("_before")) & (F.col("_key") < F.col("_after")) & (F.col("_before") <= F.col("_after"))
    return full.where(dip).select(*streets.columns)


def _register_keys(register: DataFrame, column: str) -> DataFrame:
    return register.where(trim_u(column) != "").select(sort_key(column).alias("_key")).distinct()


def in_register(streets: DataFrame, register: DataFrame, lemma: str = "lemma", column: str = "strasse") -> DataFrame:
    """Streets whose lemma, in dictionary form, is in ``register``."""
    return streets.withColumn("_key", sort_key(lemma)).join(_register_keys(register, column), "_key", "left_semi").drop("_key")


def not_in_register(streets: DataFrame, register: DataFrame, lemma: str = "lemma", column: str = "strasse") -> DataFrame:
    return streets.withColumn("_key", sort_key(lemma)).join(_register_keys(register, column), "_key", "left_anti").drop("_key")


#: Equal rows that are written out of one row at a time, and rows of a task that writes them, about.
REPEATS, TASK_ROWS = 1 << 10, 1 << 22


def validation_review(streets: DataFrame, register: DataFrame) -> DataFrame:
    """lemma, schl_nr and grund of alphabet dips and of lemmas that the register doesn't have.

    Each unknown row leads to all keys with its lemma: equal unknown lemmas multiply. So a key's row is there as
    often as its lemma is; these repeats are dealt as pieces to as many tasks as they need, as one lemma can have nearly all of them.
    """
    dips = alphabet_dips(streets).select("lemma", "schl_nr", F.lit(Reason.ALPHABET).alias("grund"))
    counts = not_in_register(streets, register).where("lemma is not null").groupBy("lemma").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum(F.col("_n").cast("double") * F.col("_n"))).first()[0] or 0
    parts = max(int(streets.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total // TASK_ROWS) + 1)
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(REPEATS).cast("long"))).alias("_at")
    pieces = streets.select("lemma", "schl_nr").join(counts, "lemma").select("lemma", "schl_nr", "_n", at).repartition(parts, "schl_nr", "_at")
    again = F.explode(F.sequence(F.lit(1), F.least(F.lit(REPEATS), F.col("_n") - F.col("_at")).cast("int")))
    every = pieces.select("lemma", "schl_nr", again.alias("_i")).select("lemma", "schl_nr", F.lit(Reason.NOT_IN_REGISTER).alias("grund"))
    return dips.unionByName(every)


def contract_violations(streets: DataFrame, stages: DataFrame, status: list[str], precisions: list[str]) -> DataFrame:
    """Rows (tabelle, schl_nr, verstoss) against enumerations and the reference of stages to streets."""

    def wrong(df: DataFrame, table: str, rule: str, ok: Column) -> DataFrame:
        return df.where(~F.coalesce(ok, F.lit(False))).select(F.lit(table).alias("tabelle"), "schl_nr", F.lit(rule).alias("verstoss"))

    orphans = stages.join(streets.select("schl_nr").distinct(), "schl_nr", "left_anti")
    return (
        wrong(streets, "streets", "status", F.col("status").isin(status))
        .unionByName(wrong(stages, "stages", "datum_praezision", F.col("datum_praezision").isin(precisions)))
        .unionByName(wrong(stages, "stages", "ist_urspruenglich", F.col("ist_urspruenglich").isin("wahr", "falsch")))
        .unionByName(orphans.select(F.lit("stages").alias("tabelle"), "schl_nr", F.lit("fremdschluessel").alias("verstoss")))
    )
