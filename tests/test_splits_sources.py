import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import splits as SP
from corpusmill.sources import readers as R
from corpusmill.sources import sinks as W


def files_for(spark, repos, per_repo=2):
    rows = [(f"own_r{r}-{i}.py", f"print({i})") for r in range(repos) for i in range(per_repo)]
    return spark.createDataFrame(rows, "filename string, content string")


def test_eleven_repositories(spark):
    s = SP.split_by_repo(files_for(spark, 11), 0.1, 0.8, 0.1, 42)
    summary = {r.set: r.repositories for r in SP.split_summary(s).collect()}
    assert summary == {"test": 1, "validation": 1, "train": 9}
    leak = {r.check: r.violations for r in SP.split_leakage(s, files_for(spark, 11)).collect()}
    assert leak == {"repos_in_several_sets": 0, "unassigned_files": 0}


def test_shares_must_sum_to_one(spark):
    with pytest.raises(ValueError):
        SP.split_by_repo(files_for(spark, 3), 0.2, 0.8, 0.1)


def test_split_independent_of_partitioning(spark):
    f = files_for(spark, 30)
    a = {tuple(r) for r in SP.split_by_repo(f.repartition(1)).collect()}
    b = {tuple(r) for r in SP.split_by_repo(f.repartition(9)).collect()}
    assert a == b


def test_token_docs_roundtrip(spark, scratch):
    d = os.path.join(scratch, "tok")
    os.makedirs(d)
    with gzip.open(os.path.join(d, "batch-1.json.gz"), "wt") as fh:
        fh.write(json.dumps({"x": "a", "y": "1", "tokens": ["p", "q"]}) + "\n")
        fh.write("null\n")
        fh.write(json.dumps({"x": "b", "y": "2", "tokens": ["r"]}) + "\n")
    with open(os.path.join(d, "notes.txt"), "w") as fh:
        fh.write("ignored")
    got = R.read_token_docs(spark, directory=d, id_fields=["x", "y"]).orderBy("id").collect()
    assert [(r.id, r.tokens) for r in got] == [("a:1", ["p", "q"]), ("b:2", ["r"])]
    one = R.read_token_docs(spark, input_file=os.path.join(d, "batch-1.json.gz"), id_fields=["x", "y"])
    assert one.count() == 2
    with pytest.raises(ValueError):
        R.read_token_docs(spark)
    out = os.path.join(scratch, "tok_out")
    df = spark.createDataFrame([("f1", ["a", "b"]), ("f2", ["c"])], "filename string, tokens array<string>")
    W.write_token_docs(df, out, 2)
    back = R.read_token_docs(spark, directory=out).orderBy("id").collect()
    assert [(r.id, r.tokens) for r in back] == [("f1", ["a", "b"]), ("f2", ["c"])]


def test_split_and_tasks_roundtrip(spark, scratch):
    s = SP.split_by_repo(files_for(spark, 5), 0.2, 0.6, 0.2)
    out = os.path.join(scratch, "sets")
    W.write_splits(s, out)
    back = R.read_split(spark, os.path.join(out, "set=train"))
    assert back.count() == s.where("set = 'train'").count()
    tasks = spark.createDataFrame([("validation", "l", "g", "r")], "set string, leftContext string, groundTruth string, rightContext string")
    tout = os.path.join(scratch, "tasks")
    W.write_tasks(tasks, tout)
    t = R.read_tasks(spark, os.path.join(tout, "set=validation")).first()
    assert (t.example_id, t.groundTruth) == (0, "g")


def test_clusters_roundtrip(spark, scratch):
    c = spark.createDataFrame([(1, ["a", "b"]), (2, ["c", "d", "e"])], "cluster_id long, members array<string>")
    out = os.path.join(scratch, "clusters")
    W.write_cluster_lists(c.coalesce(1).orderBy("cluster_id"), out)
    got = sorted(r.members for r in R.read_cluster_lists(spark, out).collect())
    assert got == [["a", "b"], ["c", "d", "e"]]
    long = spark.createDataFrame([(1, 2, "a"), (1, 2, "b"), (2, 1, "c")], "cluster_id long, size long, member string")
    W.write_clusters(long, out + "-long")
    back = R.read_clusters(spark, out + "-long", member_type="string")
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (1, "b"), (2, "c")]
    single = os.path.join(scratch, "clusters.json")
    with open(single, "w") as fh:
        json.dump([["x", "y"], ["z", "w"]], fh)
    assert R.read_cluster_lists(spark, single, single_document=True).count() == 2


def test_code_files_and_inputs(spark, scratch):
    d = os.path.join(scratch, "repo")
    os.makedirs(d)
    for name, body in [("a.py", "x = 1\n\n"), ("b.js", "var x;"), ("c.py", "")]:
        with open(os.path.join(d, name), "w") as fh:
            fh.write(body)
    files = {r.filename: r.content for r in R.read_code_files(spark, d, ".py").collect()}
    assert files == {"a.py": "x = 1\n\n", "c.py": ""}
    with open(os.path.join(d, "d e.py"), "wb") as fh:
        fh.write(b"x = '\xff'\n")
    files = {r.filename: r.content for r in R.read_code_files(spark, d, ".py").collect()}
    assert files == {"a.py": "x = 1\n\n", "c.py": "", "d e.py": "x = '\ufffd'\n"}
    R.require_inputs(spark, [d])
    with pytest.raises(FileNotFoundError):
        R.require_inputs(spark, [os.path.join(d, "missing")])
    lines = R.read_nonblank_lines(spark, os.path.join(d, "a.py")).collect()
    assert [r.value for r in lines] == ["x = 1"]


def test_sequences_and_predictions_sinks(spark, scratch):
    seqs = spark.createDataFrame([(1, "<s> a </s>  </s>")], "id long, seq string")
    out = os.path.join(scratch, "seq")
    W.write_sequences(seqs, out)
    back = R.read_sequences(spark, out).first()
    assert back.source == "a </s> </s>"
    preds = spark.createDataFrame([(2, " b "), (1, "a ")], "example_id long, pred string")
    pout = os.path.join(scratch, "pred")
    W.write_predictions(preds, pout)
    assert [r.value for r in spark.read.text(pout).collect()] == ["a", "b"]
    pairs = spark.createDataFrame([("f1", "f2", 0.5, 0.75)], "file1 string, file2 string, jaccard double, key_jaccard double")
    W.write_pairs(pairs, os.path.join(scratch, "pairs"))
    assert spark.read.csv(os.path.join(scratch, "pairs")).first()[0] == "f1"


def test_line_numbers_over_many_splits(spark, tmp_path):
    """Lines are numbered by file and position over many files and splits, and their texts are not sorted."""
    from corpusmill.sources import readers as R
    want = []
    for f in range(7):
        lines = [f"{f}:{k} " + "x" * (k % 90) for k in range((f * 137) % 400)]
        (tmp_path / f"part-{f}.txt").write_text("".join(x + "\n" for x in lines))
        want += lines
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        df = R.read_lines_indexed(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 8
        got = sorted((r.line_no, r.value) for r in df.collect())
        plan = df._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(enumerate(want))
    assert "rangepartitioning" not in plan


def test_one_json_array_read_in_byte_ranges(spark, tmp_path):
    """Brackets, quotes and escapes in names, empty clusters and white space, over split borders anywhere; also several files."""
    import random

    rng = random.Random(4)
    pool = ["]", "[", '"', "\\", ",", "a", "é", "\n", " ", "]]", '"]', "\\]"]
    docs = {f"d{k}.json": [["".join(rng.choice(pool) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(5))]
                           for _ in range(n)] for k, n in enumerate([300, 1, 0, 40])}
    for k, (name, doc) in enumerate(docs.items()):
        (tmp_path / name).write_text(json.dumps(doc, indent=[None, 1][k % 2], ensure_ascii=bool(k & 2)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("700", "61", old):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = R.read_cluster_document(spark, str(tmp_path))
            got = {}
            for r in df.collect():
                got.setdefault(r.file.rpartition("/")[2], {})[r.cluster_index] = r.members
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert got == {n: dict(enumerate(d)) for n, d in docs.items() if d}


@pytest.mark.parametrize("text", ['{"a": [1]}', '[["a"], 3, ["b"]]', '["a"]', '[["a" "b"]]'])
def test_other_json_is_an_error(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception):
        R.read_cluster_document(spark, str(tmp_path)).collect()


def test_cluster_document_roundtrip(spark, scratch):
    c = spark.createDataFrame([(7, ["a]", 'b"']), (3, ["c"]), (12, ["d", "e", "\\"])], "cluster_id long, members array<string>")
    for k, part in enumerate([c, c.limit(0)]):
        out = os.path.join(scratch, f"doc{k}")
        W.write_cluster_document(part, out)
        got = {r.cluster_index: r.members for r in R.read_cluster_lists(spark, out, single_document=True).collect()}
        assert got == ({} if k else {0: ["c"], 1: ["a]", 'b"'], 2: ["d", "e", "\\"]})


def test_token_batches_follow_the_splits(spark, scratch):
    """More input gives more batch files, so that none grows with it; few splits still give n files."""
    rows = [(f"f{i}", ["a", str(i)]) for i in range(60)]
    df = spark.createDataFrame(rows, "filename string, tokens array<string>")
    for parts, files in ((6, 6), (1, 2)):
        out = os.path.join(scratch, f"splits_{parts}")
        W.write_token_docs(df.repartition(parts), out, 2)
        assert len([f for f in os.listdir(out) if f.endswith(".gz")]) == files
        assert R.read_token_docs(spark, directory=out).count() == 60
