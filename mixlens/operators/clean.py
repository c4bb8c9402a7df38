"""Row cleaning (B1-B10). Pure transformations: no action runs inside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import align_sunday, non_negative_number, parse_mixed_date, trim_ws
from ..spec import DEFAULT_SPEC, MediaSpec


def trim_text(df: DataFrame) -> DataFrame:
    """B1: strip whitespace from every text column (whitespace-only becomes '')."""
    cols = {f.name: trim_ws(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(cols) if cols else df


def parse_dates(df: DataFrame, date_col: str) -> DataFrame:
    """B2: text/timestamp activity date -> DATE (several formats; unparsable -> NULL)."""
    if date_col not in df.columns:
        return df
    return df.withColumn(date_col, parse_mixed_date(date_col, df.schema[date_col].dataType))


def align_week(df: DataFrame, date_col: str, week_col: str) -> DataFrame:
    """Move each date forward to its Sunday; the result is the week key."""
    if date_col not in df.columns:
        return df
    df = df.withColumn(week_col, align_sunday(date_col))
    return df.drop(date_col) if date_col != week_col else df


def fix_typos(df: DataFrame, typos: dict) -> DataFrame:
    """Exact, case-sensitive value replacement per column."""
    for c, mapping in typos.items():
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            df = df.replace(mapping, subset=[c])
    return df


def fill_structural(df: DataFrame, fills: dict) -> DataFrame:
    """Structural NULLs get an explicit label."""
    present = {c: v for c, v in fills.items() if c in df.columns}
    return df.fillna(present) if present else df


def flag_credits(df: DataFrame, spend_col: str, flag_col: str) -> DataFrame:
    """Raw negative spend (before the clip) is a credit; NULL/bad text -> False."""
    if spend_col not in df.columns:
        return df.withColumn(flag_col, F.lit(False))
    raw = F.expr(f"try_cast(`{spend_col}` as double)")
    return df.withColumn(flag_col, F.coalesce(raw < 0, F.lit(False)))


FILTER_WORDS = 1 << 20         # 64-bit words (a power of two) of the filter over repeated digests: at most so many rows are broadcast


def row_digest(df: DataFrame):
    """128 bits of a row as two longs; equal rows (NULL equals NULL) have equal digests."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.array(*[c.isNull() for c in cols])                # hashes skip NULLs
    return F.xxhash64(nulls, *cols), F.xxhash64(F.lit(1), *cols, nulls)


HOT = 100_000                  # copies of a digest from which they are combined where they are read


def _held(df: DataFrame, digest, words: int, hot: int):
    """``df`` with its digests; per word of the filter the bits of digests seen twice or more and of those seen ``hot``
    times; a digest's word and bit.

    Digests are grouped, which moves 16 bytes a row and combines copies on the map side.
    """
    one, two = digest(df)
    tagged = df.withColumns({"_d1": one, "_d2": two})
    # masks, not remainders: these cannot be NULL, so the planner infers no filter on the wide digests
    place = F.col("_d1").bitwiseAND(F.lit(words - 1)).cast("int")
    bit = F.expr("shiftleft(1L, cast(_d2 & 63L as int))")
    twice = tagged.groupBy("_d1", "_d2").agg(F.count("*").alias("_n")).where("_n > 1")
    held = twice.groupBy(place.alias("_word")).agg(
        F.bit_or(bit).alias("_bits"), F.coalesce(F.bit_or(F.when(F.col("_n") >= hot, bit)), F.lit(0)).alias("_hot"),
        F.count_if(F.col("_n") >= hot).alias("_n_hot"))
    return tagged, held, place, bit


def maybe_repeated(df: DataFrame, digest=row_digest, words: int = FILTER_WORDS) -> DataFrame:
    """``df`` with ``_maybe``: false where no other row is equal.

    Digests seen twice or more set bits of a filter of ``words`` longs (a table of at most so many
    rows, broadcast), and every row looks its own bit up where it is read. A false alarm, by the
    filter or by equal digests of different rows, only marks a row that the exact step compares.
    """
    tagged, held, place, bit = _held(df, digest, words, HOT)
    return (tagged.join(F.broadcast(held), place == F.col("_word"), "left")
            .select(*[F.col(f"`{c}`") for c in df.columns],
                    (F.coalesce(F.col("_bits"), F.lit(0)).bitwiseAND(bit) != 0).alias("_maybe")))


def _apart(df: DataFrame, digest, words: int, hot: int):
    """The rows of ``df`` in three frames: those without a twin; those that may have one, with ``_d1``; those whose
    digest has ``hot`` copies. Equal rows are in the same frame."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    tagged, held, place, bit = _held(df, digest, words, hot)
    marked = tagged.join(F.broadcast(held), place == F.col("_word"), "left")
    alone = marked.where(F.coalesce(F.col("_bits"), F.lit(0)).bitwiseAND(bit) == 0).select(*cols)
    met = marked.where(F.coalesce(F.col("_bits").bitwiseAND(F.bitwise_not("_hot")), F.lit(0)).bitwiseAND(bit) != 0)
    # without any hot digest the broadcast side is empty, and adaptive execution leaves this reading out
    many = tagged.join(F.broadcast(held.where("_n_hot > 0")), (place == F.col("_word")) & (F.col("_hot").bitwiseAND(bit) != 0))
    return alone, met.select(*cols, "_d1"), many.select(*cols)


def drop_exact_duplicates(df: DataFrame, digest=row_digest, words: int = FILTER_WORDS, hot: int = HOT) -> DataFrame:
    """Full-row de-duplication (NULL equals NULL). Only rows whose digest occurs twice or more are
    moved and compared column by column; all others stay where they were read. Rows with ``hot`` copies are combined
    on the map side, others are dealt by digest first: a task groups its share, not all the rows of the split it has
    read (a hash table of whole rows that grows with the split spills)."""
    alone, met, many = _apart(df, digest, words, hot)
    return alone.unionByName(met.repartition("_d1").dropDuplicates().drop("_d1")).unionByName(many.dropDuplicates())


def count_duplicates(df: DataFrame, digest=row_digest, words: int = FILTER_WORDS, hot: int = HOT) -> DataFrame:
    """One row: ``duplicates``, the rows that B7 drops."""
    _, met, many = _apart(df, digest, words, hot)
    groups = [x.groupBy(*[F.col(f"`{c}`") for c in x.columns]).agg(F.count("*").alias("_n")).select("_n")
              for x in (met.repartition("_d1"), many)]
    return groups[0].unionByName(groups[1]).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def _crowded(df: DataFrame, slots: int, hot: int):
    """The rows of ``df`` (with ``_d1``) apart from those whose digest falls into a slot of ``hot`` rows or more, and these.
    Slots are counted on the map side; rows of a crowded one are mostly copies."""
    slot = F.col("_d1").bitwiseAND(F.lit(slots - 1)).cast("int")
    held = F.broadcast(df.groupBy(slot.alias("_slot")).agg(F.count("*").alias("_n")).where(F.col("_n") >= hot).select("_slot"))
    return df.join(held, slot == F.col("_slot"), "left_anti"), df.join(held, slot == F.col("_slot"), "left_semi")


def drop_duplicates_dealt(df: DataFrame, pieces: int, by=None, digest=row_digest, slots: int = FILTER_WORDS,
                          hot: int = HOT) -> DataFrame:
    """B7 in one shuffle, for large tables that hold many copies or are to be dealt anyway: rows go by digest to
    ``pieces`` of even size, where equal ones meet and are compared column by column. With ``by`` (a function of the
    row) the pieces are ranges of it. Rows of crowded slots are combined on the map side instead."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    few, many = _crowded(df.withColumn("_d1", digest(df)[0]), slots, hot)
    few = few.repartition(pieces, "_d1").dropDuplicates() if by is None else \
        few.withColumn("_by", by).repartitionByRange(pieces, "_by", "_d1").dropDuplicates()
    return few.select(*cols).unionByName(many.select(*cols).dropDuplicates())


def coerce_metrics(df: DataFrame, metrics) -> DataFrame:
    """Every metric (target included) numeric, NULL/bad -> 0, clipped at 0."""
    cols = {c: non_negative_number(c, df.schema[c].dataType) for c in metrics if c in df.columns}
    return df.withColumns(cols) if cols else df


def prepare(raw: DataFrame, spec: MediaSpec = DEFAULT_SPEC) -> DataFrame:
    """B1-B6, what the cleaning does before rows are compared: trim, parse, align, typo, fill, flag."""
    return (raw.transform(trim_text)
               .transform(parse_dates, spec.date_col)
               .transform(align_week, spec.date_col, spec.week_col)
               .transform(fix_typos, spec.typos)
               .transform(fill_structural, spec.fills)
               .transform(flag_credits, spec.spend_col, spec.credit_flag))


def clean(raw: DataFrame, spec: MediaSpec = DEFAULT_SPEC, pieces: int | None = None, by=None) -> DataFrame:
    """The cleaning chain in the fixed order trim, parse, align, typo, fill, flag,
    de-duplicate, coerce. Returns rows keyed by ``spec.week_col``. With ``pieces`` the rows are dealt once,
    by digest or in ranges of ``by``; else only rows that may have a twin move."""
    rows = prepare(raw, spec)
    rows = drop_duplicates_dealt(rows, pieces, by) if pieces else drop_exact_duplicates(rows)
    return rows.transform(coerce_metrics, spec.metrics)


def cleaning_counts(raw: DataFrame, pieces: int, spec: MediaSpec = DEFAULT_SPEC, digest=row_digest,
                    slots: int = FILTER_WORDS, hot: int = HOT) -> DataFrame:
    """One row: ``duplicates`` (raw rows equal to another one, but one of each) and ``clean_rows`` (rows that B9 leaves).

    Equal raw rows are equal when prepared, so raw rows dealt once, by the digest of what they become, meet for both
    comparisons: raw rows by all their columns, then the distinct ones, prepared, by all of theirs."""
    cols = raw.columns
    rows = prepare(raw.withColumn("_raw", F.struct(*[F.col(f"`{c}`") for c in cols])), spec)
    rows = rows.select("_raw", digest(rows.drop("_raw"))[0].alias("_d1")).select("_raw.*", "_d1")
    few, many = _crowded(rows, slots, hot)

    def compared(x):
        x = x.groupBy(*[F.col(f"`{c}`") for c in cols], "_d1").agg(F.count("*").alias("_n"))
        x = prepare(x, spec)
        return x.groupBy(*[F.col(f"`{c}`") for c in x.columns if c != "_n"]).agg(F.sum(F.col("_n") - 1).alias("_more")).select("_more")

    return compared(few.repartition(pieces, "_d1")).unionByName(compared(many)).agg(
        F.coalesce(F.sum("_more"), F.lit(0)).alias("duplicates"), F.count("*").alias("clean_rows"))


def date_parts(df: DataFrame, week_col: str = "week") -> DataFrame:
    """Calendar year, quarter, month, month name and ISO week of the week key."""
    w = F.col(week_col)
    return df.withColumns({
        "year": F.year(w),
        "quarter": F.quarter(w),
        "month": F.month(w),
        "month_name": F.date_format(w, "MMM"),
        "week_number": F.weekofyear(w),
    })


def label_dimension(df: DataFrame, dim: str, out: str | None = None) -> DataFrame:
    """Display label of a dimension (NULL/None/nan -> Unknown)."""
    from ..functions.exprs import label_unknown
    return df.withColumn(out or dim, label_unknown(dim))
