"""A1/A2: a spreadsheet-style export (original headers, text dates, text numbers)."""
import datetime as dt
import tempfile

from mixlens.operators.clean import clean
from mixlens.session import ensure_checkpoint_dir
from mixlens.sources.media_fact import read_media

HEADER = "Week Starting Sunday,Media Type,Channel,Sub-Channel,Site,Spend,Impressions,Base Dollar Amount"
LINES = [
    "2024-11-21,Video, TV ,VIdeo,,100.5,1000,7000000",
    "11/24/2024,Video,TV,Display,S1,-20,0,14000000",
    "2024-11-24,Social,Paid Social, VIdeo ,S2,abc,500,",
]


def test_read_export_and_clean(spark):
    root = tempfile.mkdtemp(dir=ensure_checkpoint_dir(spark).replace("file:", ""))
    with open(f"{root}/export.csv", "w") as f:
        f.write("\n".join([HEADER, *LINES]) + "\n")
    raw = read_media(spark, f"{root}/export.csv", fmt="csv", header=True)
    assert "activity_date" in raw.columns and "base_amount" in raw.columns and "sub_channel" in raw.columns
    out = clean(raw).orderBy("media_type", "spend").collect()
    assert {r.week for r in out} == {dt.date(2024, 11, 24)}
    assert [r.sub_channel for r in out] == ["Video", "Display", "Video"]
    assert [r.channel for r in out][0] == "Paid Social" and out[1].channel == "TV"
    assert sorted(r.spend for r in out) == [0.0, 0.0, 100.5]
    assert sorted(r.spend_is_credit for r in out) == [False, False, True]
    assert {r.site for r in out} == {"Unknown", "S1", "S2"}


def test_partitioned_tables_have_few_files(spark, tmp_path):
    import glob

    from mixlens.sources.io import load_table, save_table
    df = spark.range(4000).selectExpr("id", "cast(2000 + id % 4 as int) as year").repartition(16)
    save_table(df, f"{tmp_path}/t", partition_by=["year"])
    files = glob.glob(f"{tmp_path}/t/year=*/part-*")
    assert len(files) == 4 and load_table(spark, f"{tmp_path}/t").count() == 4000


def test_a_key_with_most_rows_is_written_by_many_tasks(spark, tmp_path):
    import glob

    from mixlens.sources.io import load_table, save_table
    df = spark.range(4000).selectExpr("id", "cast(if(id % 8 = 0, 2001, 2000) as int) as year").coalesce(1)
    save_table(df, f"{tmp_path}/t", partition_by=["year"], task_rows=500)
    sizes = [load_table(spark, f).count() for f in glob.glob(f"{tmp_path}/t/year=*/part-*")]
    assert sum(sizes) == 4000 and max(sizes) < 1500 and 8 <= len(sizes) <= 10
    assert load_table(spark, f"{tmp_path}/t").select("id").distinct().count() == 4000


def test_a_shape_never_refuses_a_date_that_parses(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from mixlens.functions.exprs import WHITESPACE, date_shape, parse_mixed_date, trim_ws
    from mixlens.spec import DATE_FORMATS
    assert all(date_shape(f) for f in DATE_FORMATS) and date_shape("yyyy-MM-dd'T'HH") is None
    texts = ["2024-03-05", "2024-3-5", "2024-03-05 10:11:12", "2024-03-05 1:11:12", "3/4/2024", "03/04/2024", "003/4/2024", "3/4/24", "3/4/024",
             "-3/4/2024", "3/-4/2024", "4-Mar-2024", "04-MAR-2024", "4-mar-2024", "4-March-2024", "2024/03/05", "2024/3/5", "+12024-03-05", "12024-03-05",
             "-2024-03-05", "+2024-03-05", "2/30/2024", "no date", "", " ", None, "3/4/12024", "3/4/+12024", "\t3/4/2024\u3000", "0001-01-01", "24-03-05",
             "1/1/1", "4-Sep.-2024", "2024-03-05x", "x2024-03-05", "2024-03-05\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(*[F.try_to_timestamp(F.btrim("t", F.lit(WHITESPACE)), F.lit(f)) for f in DATE_FORMATS]).cast("date")
    for r in df.select("t", parse_mixed_date("t", T.StringType()).cast("string").alias("got"), plain.cast("string").alias("want")).collect():
        assert r["got"] == r["want"], r
    odd = [f"{a}{m}{b}" for a in ("", " ", "\t", "\u2003", "~", "!", "\x7f", "é") for m in ("", "a", "a b", "ü", "~") for b in ("", " ", "\u3000", "~", "!", "é", "\x7f")]
    got = spark.createDataFrame([(t,) for t in odd], "t string").select("t", trim_ws("t").alias("g")).collect()
    assert all(r["g"] == r["t"].strip() for r in got)
