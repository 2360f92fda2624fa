import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import sequences as SQ
from corpusmill.operators import tasks as TK
from corpusmill.operators import tokenize as TOK


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first().r


def test_repo_key_and_name(spark):
    df = spark.createDataFrame([("own_my_repo-a-b.py",)], "filename string")
    r = df.select(X.repo_key("filename").alias("k")).select("k", X.repo_name("k").alias("n")).first()
    assert (r.k, r.n) == ("own_my_repo-a", "own/my_repo-a")


def test_repo_key_errors(spark):
    with pytest.raises(Exception):
        spark.createDataFrame([("nodash.py",)], "f string").select(X.repo_key("f")).collect()
    with pytest.raises(Exception):
        spark.createDataFrame([("nounderscore",)], "k string").select(X.repo_name("k")).collect()


def test_entry_id(spark):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    assert df.select(X.entry_id("a", "b")).first()[0] == "x:y"


def test_to_sequence_blank_file(spark):
    assert one(spark, X.to_sequence("v"), "\n  \n") == "<s>  </s>"
    assert one(spark, X.to_sequence("v"), "a\n\nb") == "<s> a </s> b </s>  </s>"


# what JavaScript's trim takes: Python's white space without five controls, with the byte order mark
JS_BLANKS = "".join(c for c in map(chr, range(0x10000)) if c.isspace() and c not in "\x1c\x1d\x1e\x1f\x85") + "\ufeff"


@pytest.mark.parametrize("ws,strip", [(X.PY_WS, str.strip), (X.JS_WS, lambda s: s.strip(JS_BLANKS))])
def test_unicode_white_space(spark, ws, strip):
    chars = [chr(k) for k in range(0x10000) if not 0xd800 <= k < 0xe000]
    df = spark.createDataFrame([(c, f"{c}a{c}b{c}") for c in chars], "c string, v string")
    for r in df.select("c", "v", X.nonblank("c", ws).alias("n"), X.strip_ws("v", ws).alias("s")).collect():
        assert r.n == bool(strip(r.c)) and r.s == strip(r.v), hex(ord(r.c))


def test_unicode_words_and_lines(spark):
    text = "<s>\u00a0a\u2003b\x85c\x1cd\ufeff\u3000\x0b</s>"
    assert one(spark, X.normalise_ws("v"), text) == " ".join(text.split())
    assert one(spark, X.drop_first_token("v"), text) == " ".join(text.split()[1:])
    assert one(spark, SQ.sequence_token_array("v"), text) == one(spark, SQ.seq_tokens(X.drop_first_token("v")), text)
    assert one(spark, TK.nonblank_line_indices("v"), "\u00a0\n\x85\n\ufeff\t\nx\u2028") == [1, 3]
    assert one(spark, TK.candidate_starts("v"), "\u00a0x\u3000\x1cy") == [1, 3, 4]
    assert one(spark, X.to_sequence("v"), "\u2003\nx\n\u00a0") == "<s> x </s>  </s>"


def test_normalise_ws_and_drop_first(spark):
    assert one(spark, X.normalise_ws("v"), "  a \t b\n c ") == "a b c"
    assert one(spark, X.drop_first_token("v"), "<s> a  b </s>") == "a b </s>"


def test_normalise_literals(spark):
    assert one(spark, X.normalise_literals(F.col("v")), "<STR_LIT:a b>") == "a b"
    assert one(spark, X.normalise_literals(F.col("v")), "<NUM_LIT>") == "0"
    assert one(spark, X.normalise_literals(F.col("v")), "<STR_LIT>") == ""
    assert one(spark, X.normalise_literals(F.col("v")), "x = <string:multi\nline> + <number>") == "x = multi\nline + 0"


def test_cut_prediction_modes(spark):
    assert one(spark, X.cut_prediction("v", "none"), "a {b</s>c") == "a {b"
    assert one(spark, X.cut_prediction("v", "exclusive"), "a {b</s>c") == "a "
    assert one(spark, X.cut_prediction("v", "inclusive"), "a {b</s>c") == "a {"


def test_cut_at_pad_and_pad_right(spark):
    df = spark.createDataFrame([([5, 6, 0, 7],)], "ids array<long>")
    assert df.select(X.cut_at_pad("ids", 0)).first()[0] == [5, 6]
    assert df.select(X.pad_right("ids", 6, 1)).first()[0] == [5, 6, 0, 7, 1, 1]
    assert df.select(X.non_pad_length("ids", 0)).first()[0] == 3


@pytest.mark.parametrize("n_lines,expected", [(0, 0), (1, 1), (4, 1), (5, 1), (10, 2), (25, 5), (100, 5)])
def test_sample_sizes(spark, n_lines, expected):
    content = "\n".join(f"line {i}" for i in range(n_lines)) if n_lines else "   \n\n"
    f = spark.createDataFrame([("f.py", content)], "filename string, content string")
    assert TK.sample_lines(f, 0.2, 5, 42).count() == expected


def test_tasks_reconstruct_and_supplementary(spark):
    content = "def f():\n    x = '\U0001F600\U0001F600ab'\n\n    return x\r\nend"
    f = spark.createDataFrame([("f.py", content)], "filename string, content string")
    tasks = TK.line_completion_tasks(f, 1.0, 10, 7).collect()
    assert len(tasks) == 4  # four non-blank lines
    lines = content.split("\n")
    for t in tasks:
        line = lines[t.line]
        assert t.leftContext.endswith(line[:0] if t.start == 0 else "")
        # start is a code-point index: never splits a surrogate pair in Python terms
        prefix = line[:t.start]
        assert t.leftContext == "\n".join(lines[:t.line]) + ("\n" if t.line else "") + prefix
        assert t.groundTruth == line[t.start:].strip()
        assert "\r" not in t.groundTruth
        assert not line[t.start].isspace()


def test_files_without_tokens_are_invalid(spark):
    f = spark.createDataFrame([("a.py", "x = 1\n"), ("b.py", " \n"), ("c.py", None)], "filename string, content string")
    marked = TOK.mark_valid(TOK.tokenize_regex(f))
    assert [r.valid for r in marked.orderBy("filename").collect()] == [True, False, False]
    counts = TOK.validity_counts(marked).first()
    assert (counts.total_files, counts.valid_files) == (3, 1)


def test_assign_batches_round_robin(spark):
    f = spark.createDataFrame([(f"f{i:02d}",) for i in range(10)], "filename string")
    got = {r.filename: r.batch for r in TOK.assign_batches(f, 3).collect()}
    assert got["f00"] == 1 and got["f01"] == 2 and got["f02"] == 3 and got["f03"] == 1 and got["f09"] == 1


def test_extension_null_line_and_quarantine(spark):
    df = spark.createDataFrame([("a.py",), ("a.pyc",), ("b.js",)], "f string")
    assert [r.f for r in df.where(X.has_extension("f", ".py")).collect()] == ["a.py"]
    lines = spark.createDataFrame([("null",), ('{"x": 1}',), (" null",)], "v string")
    assert lines.where(~X.is_null_line("v")).count() == 2
    f = spark.createDataFrame([("a.py", "x = 1\n"), ("b.py", "")], "filename string, content string")
    ok, bad = TOK.split_valid_invalid(TOK.mark_valid(TOK.tokenize_regex(f)))
    assert [r.filename for r in ok.collect()] == ["a.py"]
    assert [r.filename for r in bad.collect()] == ["b.py"]


def test_lexers_equal_their_patterns(spark):
    """The lexers over whole batches give the tokens of their patterns: digits before letters, every white space, characters of several bytes."""
    import random
    rng = random.Random(3)
    signs = ["a", "B", "_", "0", "9", " ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "é", "漢", "😀", "\0", "<", ">", "/", "<s>", "</s>",
             "<decoder-only>", "-"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(25))) for _ in range(3000)] + [None, "", "<s", "> 12ab3c4", "ab12cd 3"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for name, tokens, pattern in (("code_tokens", TOK.regex_tokens("v"), TOK.CODE_TOKEN_PATTERN), ("marked_tokens", SQ.seq_tokens("v"), SQ.SEQ_TOKEN_PATTERN)):
        got = df.select(tokens.alias("a"), F.regexp_extract_all("v", F.lit(pattern), F.lit(0)).alias("b"))
        assert name in got._jdf.queryExecution().optimizedPlan().toString()
        rows = got.collect()
        assert len(rows) == 3005 and all(r.a == r.b for r in rows)
