"""Golden cases of the rule catalogue (FIXTURES.md §2) on the Column rules."""

import pytest
from pyspark.sql import functions as F

from vitals.functions import rules as R


def one(spark, expr, schema, rows):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr(df).alias("x")).collect()]


def test_period(spark):
    got = one(spark, lambda d: R.classify_period(d.y), "y string", [("2018",), ("2020",), ("2021",), ("2023",),
                                                                      ("abc",), (None,), ("2019.0",)])
    assert got == ["pre-COVID", "COVID", "COVID", "post-COVID", "Ignorado", "Ignorado", "pre-COVID"]
    got = one(spark, lambda d: R.classify_period_covid(d.y), "y int", [(2020,), (2021,), (2022,)])
    assert got == ["COVID", "COVID", "post-COVID"]


def test_age_years(spark):
    rows = [(15, 1), (6, 2), (45, 3), (10, 9), (None, 3), (30, 1)]
    got = one(spark, lambda d: R.age_in_years(d.e, d.u), "e int, u int", rows)
    assert got == [0.04, 0.5, 45.0, None, None, 0.08]


def test_age_group(spark):
    rows = [(0.5,), (3.0,), (10.0,), (27.0,), (38.0,), (50.0,), (71.0,), (None,)]
    got = one(spark, lambda d: R.age_group(d.a), "a double", rows)
    assert got == ["< 1 año", "1-4", "5-14", "15-29", "30-44", "45-59", "60+", "No especificado"]


def test_age_text(spark):
    rows = [("45 a 49 años",), ("70+",), ("< 1 año",), ("sin dato",), (None,)]
    got = one(spark, lambda d: R.age_group_from_text(d.t), "t string", rows)
    assert got == ["45-59", "60 o mas", "< 1 anio", "No especificado", "No especificado"]
    got = one(spark, lambda d: R.age_label_to_dim(d.t), "t string", [("< 1 año",), ("60+",), ("1-4",), ("zz",)])
    assert got == ["< 1 anio", "60 o mas", "1-4", "No especificado"]


def test_icd(spark):
    rows = [(" j18 ",), ("u07:1",), (None,), ("I10",), ("J45",)]
    assert one(spark, lambda d: R.icd_normalise(d.c), "c string", rows) == ["J18", "U071", None, "I10", "J45"]
    chapters = one(spark, lambda d: R.icd_chapter_stage(R.icd_normalise(d.c)), "c string", rows)
    assert chapters[3] == "Enfermedades del sistema circulatorio"
    assert chapters[4] == "Enfermedades del sistema respiratorio"
    valid = [("J189",), ("W349",), ("X959",), ("J1",), ("J189XX",), (None,)]
    assert one(spark, lambda d: R.icd_valid(d.c), "c string", valid) == [True, True, True, False, True, False]
    assert one(spark, lambda d: R.icd_category(d.c), "c string", [("U071",), ("9",)]) == ["COVID-19", "Otra"]


def test_text(spark):
    rows = [("GUATEMALA ",), ("san pedro sacatepequez",), ("",), ("SAN JOSE-PINULA o'brien 2a",)]
    got = one(spark, lambda d: R.title_case(d.t), "t string", rows)
    assert got == ["Guatemala", "San Pedro Sacatepequez", None, "San Jose-Pinula O'Brien 2A"]
    assert got[3] == "SAN JOSE-PINULA o'brien 2a".title()


def test_rate(spark):
    rows = [(10, 50000), (25, 100000), (5, 0), (None, 100000)]
    assert one(spark, lambda d: R.rate_per_100k(d.f, d.p), "f int, p int", rows) == [20.0, 25.0, None, None]


def test_sex(spark):
    rows = [("F",), ("M",), (" f ",), ("X",), (None,)]
    got = one(spark, lambda d: R.sex_normalise(d.s), "s string", rows)
    assert got == ["Femenino", "Masculino", "Femenino", "No especificado", "No especificado"]
    ids = one(spark, lambda d: R.sex_id(d.s), "s string", [("Mujer",), ("Masculino",), ("otro",)])
    assert ids == [1, 2, 3]


def test_who_region(spark):
    rows = [("AMRO",), ("EURO",), ("SEARO",), ("WPRO",), ("XYZ",), (None,)]
    got = one(spark, lambda d: R.who_region_name(d.c), "c string", rows)
    assert got == ["América", "Europa", "Asia Sudoriental", "Pacífico Occidental", "Otro", "Otro"]


def test_time_split_and_quarter(spark):
    df = spark.createDataFrame([(3, "monthly"), (12, "weekly"), (2020, "annual")], "t int, u string")
    m, w = R.split_time_unit(df.t, df.u)
    assert [tuple(r) for r in df.select(m, w).collect()] == [(3, None), (None, 12), (None, None)]
    q = one(spark, lambda d: R.quarter_of(d.m), "m int", [(0,), (1,), (3,), (4,), (12,)])
    assert q == [None, 1, 1, 2, 4]


def test_codes_and_coercion(spark):
    rows = [("3.0",), (" x ",), ("5",)]
    assert one(spark, lambda d: R.normalise_code(d.v), "v string", rows) == ["3", "x", "5"]
    assert one(spark, lambda d: R.to_double(d.v), "v string", [("1.5",), ("abc",), ("nan",)]) == [1.5, None, None]
    assert one(spark, lambda d: R.to_long_or_zero(d.v), "v string", [("7.9",), ("abc",)]) == [7, 0]


def test_excess(spark):
    df = spark.createDataFrame([(115, 100.0), (114, 100.0), (5, 0.0)], "o int, b double")
    got = [tuple(r) for r in df.select(R.excess_pct(df.o, df.b).alias("p")).select(
        F.round("p", 6), R.excess_label(F.col("p"))).collect()]
    assert got == [(0.15, 1), (0.14, 0), (None, 0)]


@pytest.mark.parametrize("s", ["a-b", "x1y", "ÁNGEL ñandú", "o'neil  mc-donald", "\tnation_12 "])
def test_title_matches_python(spark, s):
    assert one(spark, lambda d: R.title_case(d.t), "t string", [(s,)]) == [s.strip().title()]


def test_iso_week_month(spark):
    import datetime as dt
    rows = [(y, w) for y in (2015, 2020, 2021) for w in (1, 9, 27, 53 if y in (2015, 2020) else 52)]
    got = one(spark, lambda d: R.iso_week_month(d.y, d.w), "y int, w int", rows)
    want = [(dt.date.fromisocalendar(y, w, 4)).month for y, w in rows]
    assert got == want


def test_cluster_conf():
    from vitals.session import cluster_conf
    conf = cluster_conf(100 * (1 << 40), 8000)  # 100 TB on 8000 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(1 << 30, 8)["spark.sql.shuffle.partitions"]) == 24


def test_rules_that_name_their_input_once(spark):
    """Blank, ICD and code rules against strip and upper, on odd text."""
    texts = [None, "", " ", "\u00a0\u2003", "\n a", "j18", " J189 ", "\u00a0u07:1", "\u0131123", "\u017f12", "\u212a12", "\u00df12",
             "a1", "\u200bA12", "A12\nB", " 7.0 ", "007", "x\u3000", ":"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    s = R.strip(F.col("c"))
    got = df.select(
        R.not_blank(F.col("c")).eqNullSafe(s != ""), R.icd_valid(F.col("c")).eqNullSafe(F.coalesce(F.upper(s).rlike("^[A-Z][0-9]{2,4}"), F.lit(False))),
        R.icd_normalise(F.col("c")).eqNullSafe(F.when(s != "", F.replace(F.upper(s), F.lit(":"), F.lit("")))),
        R.normalise_code(F.col("c")).eqNullSafe(F.coalesce(R.truncated_int(F.col("c")).cast("string"), s))).collect()
    assert [t for t, r in zip(texts, got) if not all(r)] == []
    plan = df.where(R.icd_valid(F.upper("c")) & R.not_blank(F.upper("c")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") <= 3  # one of each rule, one for NULL
