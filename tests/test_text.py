import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from uttera.functions import text as T

GOLDENS = [
    ("Vel|vet\n", None, "VELIVET", False), ("R-right, let's go!", None, "RRIGHT LET'S GO", True), ("*sigh* Fine.", None, "SIGH FINE", True), ("Well-known", None, "WELLKNOWN", True), ("Wait...what?!", None, "WAITWHAT", False),
    ("L'm sure you dont know", None, "I'M SURE YOU DON'T KNOW", False), ("1 think so", "zestiria", "I THINK SO", False), ("1 think so", "vesperia", "1 THINK SO", False), ("snake_case, 3.14", None, "SNAKECASE 314", False), ("  \n ", None, "", False),
    ("Größe", None, "GROSSE", False), ("Щука, объём и соль", None, "SHCHUKA OBIOM I SOL'", False), ("Ψυχή θέλω Ώρα", None, "PSUKHE THELO ORA", False), ("Ἀθῆναι", None, "ATHENAI", False), ("Їжак - це Ґава", None, "YIZHAK TSE GAVA", False), ("日本 ok", None, "OK", False), ("‘it’s’ “so”", None, "'IT'S' SO", False), (None, None, None, None),
]


def test_clean_goldens(spark):
    rows = spark.createDataFrame([(i, t, c) for i, (t, c, _, _) in enumerate(GOLDENS)], "i int, t string, c string").coalesce(1)
    got = rows.select(T.clean_text(F.col("t"), F.col("c")).alias("x"), T.invalid(F.col("t")).alias("bad")).collect()
    assert [(r.x, r.bad) for r in got] == [(x, bad) for _, _, x, bad in GOLDENS]


def test_similarity_goldens(spark):
    pairs = [("LETS GO NO", "LETS GO NOW", 0.952381), ("LETS GO NOW", "HELLO THERE", 0.272727), ("DONE", "", 0.0), ("tide", "diet", 0.25), ("diet", "tide", 0.5), ("", "", 1.0)]
    got = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(pairs)], "i int, a string, b string").select("i", T.matching_ratio("a", "b").alias("r"), T.levenshtein_ratio(F.col("a"), F.col("b")).alias("l")).orderBy("i").collect()
    assert [round(r.r, 6) for r in got] == [x for _, _, x in pairs]
    assert all(0 <= r.l <= 1 for r in got) and got[-1].l == 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=".a", max_size=60), min_size=1, max_size=8))
def test_collapse(texts):
    from pyspark.sql import SparkSession

    def plain(t):
        for n in range(10, 1, -1):
            t = t.replace("." * n, ".")
        return t

    spark = SparkSession.getActiveSession()
    if spark is None:
        pytest.skip("no session")
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.collapse_repeats(F.col("t")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == [plain(t) for t in texts]


def test_names_and_paths(spark):
    r = spark.range(1).select(
        T.clip_name(F.lit("YURI"), F.lit(1), F.lit(7)).alias("clip"), T.first_category(F.lit("Xillia 2 part.mp4"), ("xillia 1", "xillia 2")).alias("cat"), T.first_category(F.lit("none"), ("x",)).alias("no"),
        T.last_part(T.normal_path(F.lit("a\\b\\c.wav"))).alias("last"), T.parent_part(F.lit("a/b/c")).alias("parent"), T.strip_suffix(F.lit("c.wav")).alias("stem"), T.python_float(F.lit(0.49)).alias("f"), T.db_factor(F.lit(20.0)).alias("db"),
    ).first()
    assert tuple(r) == ("YURI-1-0007", "xillia 2", None, "c.wav", "b", "c", "0.49", 10.0)


def test_python_float(spark):
    values = [0.0, -0.0, 0.5, 1.0, -2.75, 0.0005, 0.00012345, 0.0001, 0.00001, 1.5e-7, 12345678.5, 1e7, 1.2345e10, 123456789012345.6, 1e15, 1e16, 1.5e16, -3e200, 1e-300, 0.12, float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", T.python_float(F.col("x")).alias("s"))
    assert [r.s for r in df.collect()] == [None if v is None else repr(v) for v in values]
