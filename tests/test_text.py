"""Column functions against hand cases (FIXTURES.md §2) and invariants."""

import pytest
from pyspark.sql import functions as F

from sqlscore.functions import schema as S
from sqlscore.functions import text as T


def one(spark, col_fn, *values, schema=None):
    names = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([tuple(values)], schema or ", ".join(f"{n} string" for n in names))
    return df.select(col_fn(*[F.col(n) for n in names]).alias("r")).first()["r"]


def test_extract_tagged(spark):
    assert one(spark, T.extract_sql, "<think>a\nb</think><answer>SELECT 1</answer>") == "SELECT 1"


def test_extract_fence_without_blank_keeps_text(spark):
    # ```sql marker present but the fence regex needs blanks: text kept, plain fence not tried
    assert one(spark, T.extract_sql, "```sql SELECT 1```") == "```sql SELECT 1```"


def test_extract_fenced_and_plain(spark):
    assert one(spark, T.extract_sql, "Here:\n```SQL\nSELECT 2\n```\nbye") == "SELECT 2"
    assert one(spark, T.extract_sql, "x ``` SELECT 3 ``` y") == "SELECT 3"


def test_strip_is_ascii_whitespace(spark):
    assert one(spark, T.py_strip, " \t\x0b\x0cab c\r\n ") == "ab c"


def test_token_count(spark):
    assert one(spark, T.token_count, "SELECT 1") == 2
    assert one(spark, T.token_count, "SELECT 1;") == 3
    assert one(spark, T.token_count, "-- only a comment") == 1
    assert one(spark, T.token_count, "SELECT 'a b c' FROM t") == 4


def test_quality_values(spark):
    assert one(spark, T.quality, "SELECT 1") == pytest.approx(0.8)
    assert one(spark, T.quality, "SELECT a FROM t WHERE b JOIN c GROUP BY d") == 1.0
    assert one(spark, T.keyword_count, "select a from t group by a order by a") == 4


def test_normalize_hand_case(spark):
    src = "SELECT  A -- c\nFROM T WHERE x='It''s -- B'"
    assert one(spark, T.normalize_sql, src) == "select a from t where x='It''s -- B'"


def test_comments_and_quoted_names(spark):
    assert one(spark, T.normalize_sql, "SELECT a/*c*/FROM T") == "select a from t"
    assert one(spark, T.normalize_sql, 'SELECT "a--b" AS X') == 'select "a--b" as x'
    assert one(spark, T.normalize_sql, 'SELECT "It\'s" AS A, B FROM T') == 'select "It\'s" as a, b from t'
    assert one(spark, T.normalize_sql, "SELECT 'A' -- it's\n, B") == "select 'A' , b"
    assert one(spark, T.normalize_sql, "SELECT 'open") == "select 'open"


def test_long_literals_do_not_recurse(spark):
    long = "SELECT '" + "x" * 100_000 + "' || '" + "''" * 50_000 + '\' || "' + "y" * 100_000 + '" /* ' + "z" * 100_000 + " */ FROM T"
    assert one(spark, T.token_count, long) == 9
    assert one(spark, T.normalize_sql, long).endswith(" from t")


def test_normalize_idempotent_on_documents(spark):
    from conftest import SF001
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    n = docs.select(T.normalize_sql(F.col("text")).alias("n"))
    assert n.where(T.normalize_sql(F.col("n")) != F.col("n")).count() == 0


def test_jaccard(spark):
    assert one(spark, T.token_jaccard, "select name from users", "select name from users;") == pytest.approx(0.6)
    assert one(spark, T.token_jaccard, "", "a") == 0.0
    assert one(spark, T.token_jaccard, "a b", "b a") == 1.0


def test_jaccard_symmetric_on_documents(spark):
    from conftest import SF001
    d = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", T.sql_tokens(F.col("text")).alias("t"))
    a, b = d.alias("a"), d.alias("b")
    j = a.join(b, F.col("b.doc_id") == F.col("a.doc_id") + 1)
    bad = j.where(T.jaccard_sets(F.col("a.t"), F.col("b.t")) != T.jaccard_sets(F.col("b.t"), F.col("a.t")))
    assert bad.count() == 0


def test_sql_tokens_equals_tokens_of_normal_form(spark):
    from conftest import SF001
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    diff = d.where(F.array_sort(T.sql_tokens(F.col("text"))) != F.array_sort(T.tokens(T.normalize_sql(F.col("text")))))
    assert diff.count() == 0


def test_format_and_custom_scores(spark):
    assert one(spark, T.format_score, " <think>x</think>\n<answer>SELECT 1</answer> ") == 1.0
    assert one(spark, T.format_score, "SELECT 1") == 0.0
    assert one(spark, T.custom_keyword_score, "create index i on t") == 1.0
    assert one(spark, T.custom_keyword_score, "select 1") == 0.5


def test_extract_schema(spark):
    assert one(spark, S.extract_schema, "see CREATE table t (a int)") == "see CREATE table t (a int)"
    assert one(spark, S.extract_schema, "intro\nmore\ninsert into t values (1)\nend") == "insert into t values (1)\nend"
    assert one(spark, S.extract_schema, "no schema here") == ""


ODD_TEXTS = [None, "", " ", "\t\n", "a", " a ", "a  b", "a\tb", "a \n b", "\x0ba\x0c", "A B", "a b ", ";", "a;b", "a ;b; ", "SELECT A  FROM T;",
             "-- c", "A--x\nB", "A -- x\n B", "A/*c*/B", "A /* c\nd */ B", "A/*open", "A--", "/**/", "A/**/--B\n--C", "- - / *", "A-/*x*/-B",
             "'It''s -- B' A", "A'open -- B", 'SELECT "A--B" X /* \'q */', "-- it's\nA", "'A' /* b */ \"C\"\"D\"", "\u00a0A\u2003B", "\u039f\u0394\u039f\u03a3--x\n\u03a3\u0391",
             "\u039f\u03a3/**/\u03a3\u0391\u03a3", "x\u00dfY  \U0001f600Z", "a\x00 b"]


def test_texts_of_all_shapes(spark):
    import re

    def norm(c):
        parts = re.split(f"({T.UNITS})", c)
        folded = "".join(p.lower() if i % 2 == 0 else " " if p.startswith(("--", "/*")) else p for i, p in enumerate(parts))
        return re.sub(f"{T.WS}+", " ", folded).strip(T.WS_CHARS)

    def count(c):
        s = re.sub(T.UNITS, " L ", c).replace(";", " ; ").strip(T.WS_CHARS)
        return len(re.split(f"{T.WS}+", s)) if s else 0
    df = spark.createDataFrame([(t,) for t in ODD_TEXTS], "c string")
    got = df.select("c", T.normalize_sql("c"), T.token_count("c")).collect()
    assert [tuple(r) for r in got] == [(t, None, None) if t is None else (t, norm(t), count(t)) for t in ODD_TEXTS]


def test_fences_of_all_shapes(spark):
    cases = {None: None, "": "", "``": "``", "```": "```", "``` a ```": "a", "```sql a ```": "a", "```SQL\na\n``` ``` b ```": "a", "```SqL a```": "```SqL a```",
             "x ``` a ``` ```sql b ```": "b", " sql ``` A\nB\t``` ": "A\nB", "```sqlx a ```": "```sqlx a ```"}
    df = spark.createDataFrame([(t,) for t in cases], "c string")
    assert {r[0]: r[1] for r in df.select("c", T.extract_sql_stage2("c")).collect()} == cases


def test_no_pattern_is_compiled_for_plain_texts(spark):
    df = spark.createDataFrame([("a",)], "c string")

    def plan(c):
        return df.select(c)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan(T.token_count("c"))  # a split by a pattern compiles it for every text
    taken_apart = plan(T.fold_outside("c"))
    assert taken_apart.index("split(") > taken_apart.index("Contains(c") and "--)" not in taken_apart[:taken_apart.index("split(")]  # comments alone need no split
    assert plan(T.normalize_sql("c")).startswith("Project [trim(CASE WHEN")  # collapses only what is not single blanks


def test_previews(spark):
    long = "x" * 250
    assert one(spark, T.truncate_long, long) == "x" * 200 + "..."
    assert one(spark, T.truncate_long, "short") == "short"
    assert one(spark, lambda c: T.preview(c, 100, True), long) == "x" * 100 + "..."
