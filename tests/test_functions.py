"""Scalar functions against the hand-worked fixtures (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from taxonomy_helpers import one
from mvtax.functions import params as P
from mvtax.functions import text as T


@pytest.mark.parametrize("value,expected", [
    ("['PLC panels', 'SCADA, HMI']", ["PLC panels", "SCADA, HMI"]),
    ("a; b, c|d", ["a", "b", "c", "d"]),
    ("[1, 2]", ["1", "2"]),
    ("", []),
    ("  x \t y ", ["x", "y"]),
])
def test_to_list(spark, value, expected):
    assert one(spark, T.to_list("s"), value) == expected


@pytest.mark.parametrize("value,expected", [
    ("fire alarm/hvac-plc", "Fire Alarm/HVAC-PLC"),
    ("iFIX & rtu", "Ifix & RTU"),
    ("  scada  systems ", "SCADA  Systems"),
])
def test_title_case(spark, value, expected):
    assert one(spark, T.title_case_keep_acronyms("s"), value) == expected


@pytest.mark.parametrize("value,expected", [
    ("Fire fire Alarm!! Systems", "Fire Alarm"),
    ("HVAC & Building Services", "HVAC & Building"),
    ("- Global Group -", "Global"),
    ("alarm alarm ALARM panels", "alarm panels"),
])
def test_sanitize_label(spark, value, expected):
    assert one(spark, T.sanitize_label("s"), value) == expected


def test_tokens_and_ngrams(spark):
    # "plc" and "systems" are stopwords (company-suffix words)
    toks = one(spark, T.tokens("s"), "The PLC & SCADA systems of Acme-Co, 3d/printing")
    assert toks == ["&", "scada", "acme-co", "3d/printing"]
    df = spark.createDataFrame([(toks,)], "t array<string>")
    assert df.select(T.ngrams("t", 3)).first()[0] == ["& scada acme-co", "scada acme-co 3d/printing"]
    assert df.select(T.ngrams(F.slice("t", 1, 1), 2)).first()[0] == []


def test_py_title(spark):
    assert one(spark, T.py_title("s"), "co2-based 3d x&y") == "Co2-Based 3D X&Y"


def test_ratio_format(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 1), (5, 8)], "c long, t long")
    got = [r[0] for r in df.select(T.fmt_ratio2("c", "t")).collect()]
    assert got == ["0.12", "0.33", "0.67", "0.00", "0.62"]


@pytest.mark.parametrize("n,base,expected", [
    (100, (6, 8, 10), (4, 6, 7)),
    (500, (6, 8, 10), (5, 7, 9)),
    (625, (6, 8, 10), (6, 8, 10)),
    (2000, (6, 8, 10), (10, 13, 16)),
    (5, (8, 12, 18), (4, 4, 4)),
])
def test_adaptive_kset(spark, n, base, expected):
    df = spark.createDataFrame([(n,)], "n long")
    got = df.select(P.clamp_kset_col(P.adaptive_kset_col("n", base), "n")).first()[0]
    assert tuple(got) == tuple(sorted({max(1, min(k, n - 1)) for k in expected}))


def test_k_score(spark):
    # counts 6, 3, 1 -> share .6, imbalance .61644; sil .2, k = 3, Broad limit .35
    df = spark.createDataFrame([(0.2, 3, 0.6164414, 0.6)], "sil double, k int, imb double, big double")
    assert df.select(P.k_score_col("sil", "k", "imb", "big", 0.35)).first()[0] == pytest.approx(-0.05033, abs=1e-5)


def test_strict_sector(spark):
    from mvtax.operators.rules import strict_sector
    for label, texts, want in (("Fire Alarm", "maker of fire alarm panels", "Fire & Life Safety"), ("Power & Energy", "fire alarm", "Power & Energy"),
                               ("Odd Name", "nothing known", "Specialist Sector"), ("", "plc and scada", "Industrial Automation")):
        got = spark.createDataFrame([(label, texts)], "l string, t string").select(strict_sector("l", "t").alias("o")).first()["o"]
        assert got == want


def test_gram_heads_are_counted_inside_the_row(spark, tmp_path):
    """No gram moves where keys do not repeat; rows that repeat a key, or have none, are one; against a plain count."""
    from collections import Counter
    from mvtax.config import GENERIC_BAN
    from mvtax.operators.rules import gram_heads, row_grams
    ban = sorted(GENERIC_BAN)[0]
    texts = ["b c b c b c", "k b c k b c x", f"{ban} red pump {ban} red pump {ban}", "solo", "", None, "q r s q r t", f"{ban} {ban}"]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, s string")
    heads = gram_heads(df, ["id"], F.col("s"))
    assert "Exchange" not in heads._jdf.queryExecution().executedPlan().toString()

    def head(several):
        counts, first = Counter(), {}
        for t in several:
            t = (t or "").split()
            for n in (2, 3):
                for p in range(len(t) - n + 1):
                    gram = (n, " ".join(t[p:p + n]))
                    if ban not in t[p:p + n]:
                        counts[gram] += 1
                        first[gram] = min(p, first.get(gram, p))
        return min(counts, key=lambda g: (-counts[g], -g[0], first[g]))[1].title() if counts else None

    assert {r.id: r.gram_head for r in heads.collect()} == {i: head([t]) for i, t in rows if head([t])}
    more = rows + [(0, "z z z z z z z z"), (None, "m n m n"), (None, "n m")]
    got = {r.id: r.gram_head for r in gram_heads(spark.createDataFrame(more, "id long, s string"), ["id"], F.col("s")).collect()}
    want = {i: head([t for j, t in more if j == i]) for i in {j for j, _ in more}}
    assert got == {i: h for i, h in want.items() if h}
    g = spark.createDataFrame([(["a", "b", ban, "c", "d"],), ([],), (None,)], "t array<string>").select(row_grams("t").alias("g")).select("g.*").collect()
    assert [tuple(r) for r in g] == [(4, 3, 2, "A B"), (0, 0, 0, None), (0, 0, 0, None)]


def test_norm_and_vector_are_computed_once_a_row(spark):
    """The norm used to be computed again for every element, and with it the expression of the vector."""
    from mvtax.functions.vector import l2_normalize
    rows = [([3.0, 4.0],), ([0.0, -0.0, 0.0],), ([],), (None,), ([1e-3 * i for i in range(300)],)]
    df = spark.createDataFrame(rows, "v array<double>")
    plan = df.select(l2_normalize(F.transform("v", lambda x: x * 2.0)).alias("o"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("aggregate(") == 1 and text.count("2.0") == 1
    got = [r.o for r in plan.collect()]
    nrm = F.sqrt(F.aggregate("w", F.lit(0.0), lambda a, x: a + x * x))
    plain = F.when(nrm > 0, F.transform("w", lambda x: x / nrm)).otherwise(F.transform("w", lambda x: x * 0.0))
    want = [r.o for r in df.select(F.transform("v", lambda x: x * 2.0).alias("w")).select(plain.alias("o")).collect()]
    assert got == want and got[0] == [0.6, 0.8] and got[3] is None
