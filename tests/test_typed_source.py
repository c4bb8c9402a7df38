"""Declared types of an export: casts, rejected values, absent and extra columns."""
import datetime as dt
from decimal import Decimal

from mixlens.operators.clean import clean
from mixlens.sources.media_fact import MEDIA_SCHEMA, read_media, rejects, typed, untyped


def _csv(spark, tmp_path):
    lines = ["Week Starting Sunday,Channel,Spend,Clicks,Base Dollar Amount,Note",
             '3/4/2024,Radio, 12.50 ,7,100,a', '2024-03-05,TV,n/a,8,,b', 'someday,TV,-3,x,50,c', ',Radio,,,,']
    path = tmp_path / "export.csv"
    path.write_text("\n".join(lines))
    return str(path)


def test_csv_arrives_typed_and_rejects_are_counted(spark, tmp_path):
    path = _csv(spark, tmp_path)
    df = read_media(spark, path, fmt="csv", header=True)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    declared = {f.name: f.dataType for f in MEDIA_SCHEMA.fields}
    assert all(kinds[c] == declared[c] for c in kinds if c in declared) and "Note" in kinds
    got = df.orderBy("Note").collect()
    assert [r["activity_date"] for r in got] == [None, dt.date(2024, 3, 4), dt.date(2024, 3, 5), None]
    assert [r["spend"] for r in got] == [None, Decimal("12.5"), None, Decimal("-3")]
    bad = {r["column"]: r["bad_values"] for r in rejects(untyped(spark, path, "csv", header=True)).collect()}
    assert bad == {"activity_date": 1, "spend": 1, "clicks": 1}
    kept = clean(df)
    assert kept.count() == 4 and {r["spend_is_credit"] for r in kept.collect()} == {True, False}
    assert min(r["spend"] for r in kept.collect()) == 0                 # clipped after the flag


def test_types_already_there_and_nothing_declared(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 3), 5, 1.5)], "activity_date date, clicks bigint, other double")
    out = typed(df)
    assert out.columns == df.columns and out.first()["clicks"] == 5 and out.schema["clicks"].dataType == df.schema["clicks"].dataType
    assert rejects(df).count() == 0 and rejects(df.select("other")).count() == 0
    assert rejects(df.limit(0)).count() == 0
