"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator
check.  Every query reads the driver tables (through ``standins``) and runs
over whole tables and whole texts.  Computed columns carry the same names as
in ``plans/oracle.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import bags as B
from corpusmill.operators import dedup as D
from corpusmill.operators import evaluation as E
from corpusmill.operators import graph as G
from corpusmill.operators import logs as L
from corpusmill.operators import neardup as N
from corpusmill.operators import ordering as O
from corpusmill.operators import sequences as Q
from corpusmill.operators import splits as SP
from corpusmill.operators import tasks as TK
from corpusmill.operators import tokenize as TOK
from corpusmill.plans import standins as S

Query = Callable[[SparkSession, str], DataFrame]

SEED = 42
SHARES = (0.1, 0.8, 0.1)  # test, train, validation


# --- shared building blocks ---------------------------------------------------

def _nd(spark, sf):
    return N.near_duplicates(S.token_docs(spark, sf))


def _components(spark, sf):
    return D.clone_clusters(_nd(spark, sf))


def _splits(spark, sf):
    t, tr, v = SHARES
    return SP.split_by_repo(S.files(spark, sf), t, tr, v, SEED)


def _tasks(spark, sf):
    return TK.tasks_for_sets(_splits(spark, sf), S.files(spark, sf), 0.2, 5, SEED)


def _predictions(spark, sf):
    """Predictions stand-in: deterministic edits of the ground truth."""
    t = _tasks(spark, sf).join(S.files(spark, sf).select("filename", "doc_id"), "filename")
    g = F.col("groundTruth")
    r = F.pmod(F.col("doc_id"), F.lit(4))
    pred = (F.when(r == 0, g)
            .when(r == 1, F.substring(g, F.lit(1), F.length(g) - 1))
            .when(r == 2, F.concat(g, F.lit("</s>x")))
            .otherwise(F.concat(g, F.lit("{"))))
    return t.select((F.col("doc_id") * 1000 + F.col("line")).alias("example_id"),
                    pred.alias("pred"), g.alias("gold"), "leftContext")


# --- tokenisation -------------------------------------------------------------

def q_tokenize_regex(spark, sf):
    d = S.token_docs(spark, sf)
    return d.select(F.col("id").alias("doc_id"), F.size("tokens").alias("n_tokens"),
                    F.size(F.array_distinct("tokens")).alias("n_distinct"),
                    F.get("tokens", 0).alias("first_token"),
                    F.get("tokens", F.size("tokens") - 1).alias("last_token"))


def q_only_identifiers(spark, sf):
    f = S.files(spark, sf)
    t = TOK.tokenize_regex(f, only_identifiers=True)
    return t.select("doc_id", F.size("tokens").alias("n_identifiers"))


def q_tokenize_validity(spark, sf):
    return TOK.validity_counts(TOK.mark_valid(TOK.tokenize_regex(S.files(spark, sf))))


def q_batch_assignment(spark, sf):
    f = S.files(spark, sf).select("filename")
    return TOK.assign_batches(f, 8, "filename").select("filename", "batch")


# --- bags and filters ---------------------------------------------------------

def q_token_bag(spark, sf):
    return B.token_bag(S.token_docs(spark, sf), "id", "tokens").withColumnRenamed("id", "doc_id")


def q_doc_totals(spark, sf):
    return B.doc_totals(S.token_docs(spark, sf), "id", "tokens").withColumnRenamed("id", "doc_id")


def q_min_token_filter(spark, sf):
    return B.min_tokens(S.token_docs(spark, sf)).select(F.col("id").alias("doc_id"))


def q_index_size(spark, sf):
    return B.index_size(B.min_tokens(S.token_docs(spark, sf)), "project")


# --- near duplicates ----------------------------------------------------------

def q_near_dup_pairs(spark, sf):
    return _nd(spark, sf).all_pairs()


def q_near_dup_edges(spark, sf):
    return _nd(spark, sf).edges()


def q_pair_similarity(spark, sf):
    """JN2/JN3 on documents that follow one another in id order, whatever ids are missing between them."""
    docs = S.token_docs(spark, sf)
    bags = (B.token_bag(docs, "id", "tokens").groupBy("id")
            .agg(F.map_from_entries(F.collect_list(F.struct("token", "cnt"))).alias("bag")))
    a = bags.select(F.col("id").alias("id1"), F.col("bag").alias("ba"))
    b = bags.select(F.col("id").alias("id2"), F.col("bag").alias("bb"))
    place = O.with_row_index(bags.select("id"), [F.col("id")], "place")
    after = place.select(F.col("id").alias("id1"), (F.col("place") + 1).alias("place")).join(
        place.select(F.col("id").alias("id2"), "place"), "place").select("id1", "id2")
    j = a.join(after, "id1").join(b, "id2")
    return j.select("id1", "id2", N.key_jaccard(F.map_keys("ba"), F.map_keys("bb")).alias("key_jaccard"),
                    N.multiset_jaccard(F.col("ba"), F.col("bb")).alias("jaccard"))


def q_pairs_by_project(spark, sf):
    docs = S.token_docs(spark, sf)
    return N.pairs_by_project(N.near_duplicates(docs), docs.select("id", "project"))


def q_leader_pairs(spark, sf):
    return D.leader_assignment(_nd(spark, sf))


def q_symmetric_edges(spark, sf):
    return G.symmetrise(_nd(spark, sf).all_pairs())


def q_clone_clusters(spark, sf):
    return _components(spark, sf)


def q_cluster_lists(spark, sf):
    return G.cluster_members(_components(spark, sf))


def q_cluster_sizes(spark, sf):
    return G.cluster_sizes(_components(spark, sf))


def q_cluster_summary(spark, sf):
    return D.cluster_summary(_components(spark, sf))


def q_removal_counts(spark, sf):
    return D.removal_counts(_components(spark, sf))


def q_dedup_keep_first(spark, sf):
    comp = _components(spark, sf)
    files = S.files(spark, sf).select(F.col("doc_id").alias("id"), "filename")
    kept = D.drop_cluster_losers(files, D.cluster_losers(comp), "id")
    return kept.select(F.col("id").alias("doc_id"), "filename")


def q_dedup_leader(spark, sf):
    nd = _nd(spark, sf)
    dups = D.leader_assignment(nd).select(F.col("duplicate").alias("id"))
    files = S.files(spark, sf).select(F.col("doc_id").alias("id"), "filename")
    return D.drop_cluster_losers(files, dups, "id").select(F.col("id").alias("doc_id"), "filename")


# --- splits -------------------------------------------------------------------

def q_repo_names(spark, sf):
    return SP.with_repo_columns(S.files(spark, sf).select("filename"))


def q_split_by_repo(spark, sf):
    return _splits(spark, sf)


def q_split_leakage(spark, sf):
    return SP.split_leakage(_splits(spark, sf), S.files(spark, sf))


def q_files_by_repo(spark, sf):
    return SP.files_by_repo(S.files(spark, sf))


def q_split_summary(spark, sf):
    return SP.split_summary(_splits(spark, sf))


# --- line-completion tasks ----------------------------------------------------

def q_nonblank_line_positions(spark, sf):
    f = S.files(spark, sf)
    nb = TK.nonblank_line_indices("content")
    return f.select("doc_id", F.size(X.split_lines("content")).alias("n_lines"),
                    F.size(nb).alias("n_nonblank"), F.get(nb, 0).alias("first_nonblank"))


def q_candidate_starts(spark, sf):
    f = S.files(spark, sf)
    lines = f.select("doc_id", F.posexplode(X.split_lines("content")).alias("line_no", "line"))
    st = TK.candidate_starts("line")
    return lines.where(F.size(st) > 0).select("doc_id", "line_no", F.size(st).alias("n_starts"), F.get(st, 0).alias("first_start"),
                        F.get(st, F.size(st) - 1).alias("last_start"))


def q_sample_lines(spark, sf):
    f = S.files(spark, sf).select("filename", "content")
    return TK.sample_lines(f, 0.2, 5, SEED).select("filename", "line")


def q_line_completion_tasks(spark, sf):
    t = _tasks(spark, sf)
    return t.select("set", "filename", "line", "start", "groundTruth",
                    F.md5("leftContext").alias("left_md5"), F.md5("rightContext").alias("right_md5"),
                    F.length("leftContext").alias("left_len"), F.length("rightContext").alias("right_len"))


def q_task_statistics(spark, sf):
    sp = _splits(spark, sf)
    t = TK.tasks_for_sets(sp, S.files(spark, sf), 0.2, 5, SEED)
    return TK.task_statistics(sp, t)


# --- sequences and windows ----------------------------------------------------

def _seqs(spark, sf):
    f = S.files(spark, sf).select(F.col("doc_id").alias("id"), "content")
    return Q.train_sequences(f)


def q_train_sequences(spark, sf):
    s = _seqs(spark, sf)
    return s.select(F.col("id").alias("doc_id"), F.length("seq").alias("seq_len"), F.md5("seq").alias("seq_md5"))


def q_normalise_ws(spark, sf):
    f = S.files(spark, sf)
    n = X.normalise_ws("content")
    return f.select("doc_id", F.length(n).alias("norm_len"), F.md5(n).alias("norm_md5"))


def q_unicode_words(spark, sf):
    """Words and lines of the documents, whose blanks, full stops and letters e stand as white
    space beyond ASCII: two that both languages know, and one that is Python's alone."""
    v = F.translate("content", " .e", "\u00a0\u2003\u0085")
    n = X.normalise_ws(v)
    return S.files(spark, sf).select(
        "doc_id", F.length(n).alias("norm_len"), F.md5(n).alias("norm_md5"),
        F.size(TK.nonblank_line_indices(v)).alias("n_nonblank"),
        F.length(X.strip_ws(v)).alias("python_len"), F.length(X.strip_ws(v, X.JS_WS)).alias("script_len"))


def q_sequence_tokens(spark, sf):
    t = Q.sequence_tokens(_seqs(spark, sf))
    return t.select(F.col("id").alias("doc_id"), F.size("tokens").alias("n_tokens"),
                    F.md5("data").alias("data_md5"))


def q_eol_marker(spark, sf):
    f = S.files(spark, sf)
    with_eol = F.replace(F.col("content"), F.lit("\n"), F.lit(X.EOL_MARKER))
    return f.select("doc_id", F.md5(X.eol_to_marker(with_eol)).alias("eol_md5"))


def q_train_windows(spark, sf):
    t = _seqs(spark, sf).select("id", Q.sequence_token_array("seq").alias("tokens"))
    w = Q.token_windows(t.select("id", "tokens"), "tokens", 1000, 100)
    return w.select(F.col("id").alias("doc_id"), "window_index", "window_start",
                    F.size("window").alias("window_len"),
                    F.get("window", 3).alias("first_token"),
                    F.get("window", F.size("window") - 1).alias("last_token"))


def q_window_counts(spark, sf):
    t = _seqs(spark, sf).select("id", Q.sequence_token_array("seq").alias("tokens"))
    return t.select(F.col("id").alias("doc_id"), Q.window_count(F.size("tokens"), 1000, 100).alias("windows"))


def q_window_totals(spark, sf):
    """Sequence lines written as text, with blank lines among them, and read back."""
    out = _io_dir(spark, "windows")
    s = _seqs(spark, sf)
    lines = s.select(F.explode(F.array(F.col("seq"), F.when(F.col("id") % 3 == 0, F.lit(" ")).otherwise(F.lit("")))).alias("value"))
    lines.write.text(out)
    return Q.window_totals(spark.read.text(out))


def _train_features(spark, sf):
    return Q.train_features(_seqs(spark, sf), None, 1000, 100)


def _digest(ids):
    """All ids of a row, as a digest: a wrong lookup changes it."""
    return F.md5(F.array_join(F.col(ids).cast("array<string>"), ",")).alias("ids_md5")


def q_padded_windows(spark, sf):
    tf = _train_features(spark, sf)
    return tf.select(F.col("id").alias("doc_id"), "window_index", "n_real",
                     F.size("ids").alias("n_ids"), X.non_pad_length("ids", Q.PAD_ID).alias("non_pad"),
                     F.size(X.cut_at_pad("ids", Q.PAD_ID)).alias("cut_len"), _digest("ids"))


def q_vocab_encode(spark, sf):
    t = _seqs(spark, sf).select("id", Q.sequence_token_array("seq").alias("tokens"))
    return B.build_vocab(t)


def q_validation_features(spark, sf):
    t = _predictions(spark, sf).select("example_id", "leftContext", F.col("gold").alias("groundTruth"))
    vocab = B.build_vocab(_seqs(spark, sf).select("id", Q.sequence_token_array("seq").alias("tokens")))
    v = Q.validation_features(t, vocab, 936)
    return v.select(F.col("id").alias("example_id"), "n_real", F.size("ids").alias("n_ids"), _digest("ids"),
                    F.md5("groundTruth").alias("truth_md5"))


def q_truncated_features(spark, sf):
    t = _predictions(spark, sf).select("example_id", F.col("leftContext").alias("source"))
    vocab = B.build_vocab(_seqs(spark, sf).select("id", Q.sequence_token_array("seq").alias("tokens")))
    v = Q.truncated_features(t, vocab, 936, 64, "test", "example_id", "source")
    return v.select(F.col("id").alias("example_id"), "n_real", _digest("ids"))


def q_padding_stats(spark, sf):
    tf = _train_features(spark, sf)
    # the ids themselves are not needed to number and measure the windows
    batched = O.fixed_batches(tf.select("id", "window_index", "n_real"), 8, [F.col("id"), F.col("window_index")])
    return batched.groupBy("batch").agg(F.max("n_real").alias("max_len"), F.count(F.lit(1)).alias("rows"))


# --- evaluation ---------------------------------------------------------------

def q_cut_predictions(spark, sf):
    p = _predictions(spark, sf)
    return p.select("example_id", X.cut_prediction("pred", "none").alias("cut_none"),
                    X.cut_prediction("pred", "exclusive").alias("cut_exclusive"),
                    X.cut_prediction("pred", "inclusive").alias("cut_inclusive"))


def q_normalise_literals(spark, sf):
    f = S.files(spark, sf)
    code = F.concat(F.lit("<string:"), F.col("content"), F.lit("> = <NUM_LIT> + <STR_LIT> + <char_LIT:"),
                    F.col("doc_id").cast("string"), F.lit(">"))
    return f.select("doc_id", X.normalise_literals(code).alias("normalised"))


def _scored(spark, sf, indel=True):
    p = E.prepare_predictions(_predictions(spark, sf), "none")
    return E.score_rows(p, indel=indel)


def q_exact_match(spark, sf):
    return E.exact_match(_scored(spark, sf, indel=False))


def q_edit_similarity_native(spark, sf):
    return E.edit_similarity(_scored(spark, sf, indel=False))


def q_edit_similarity(spark, sf):
    return E.edit_similarity(_scored(spark, sf, indel=True))


def q_older_scores(spark, sf):
    """AGG13/AGG14 as the older script scores: cut at the brace, literals normalised on both sides."""
    p = _predictions(spark, sf).select("example_id", F.concat(F.lit("0"), "pred").alias("pred"),
                                       F.concat(F.lit("<NUM_LIT>"), "gold", F.lit("<STR_LIT>")).alias("gold"))
    scored = E.score_rows(E.prepare_predictions(p, "exclusive", literals=True))
    return scored.agg(F.round(F.avg("exact") * 100, 2).alias("exact_match"),
                      F.round(F.avg("edit_sim"), 2).alias("edit_similarity"))


def q_zip_rows(spark, sf):
    p = _predictions(spark, sf)
    a = p.select("example_id", "pred")
    b = p.select(F.col("example_id").alias("gold_id"), "gold")
    z = O.zip_rows(a, b, [F.col("example_id")], [F.col("gold_id")])
    return z.select("row_index", "example_id", "gold_id")


def q_seeded_shuffle(spark, sf):
    f = S.files(spark, sf).select("doc_id")
    return O.seeded_shuffle(f, "doc_id", SEED).select("doc_id", "shuffle_key")


def q_fixed_batches(spark, sf):
    p = _predictions(spark, sf).select("example_id")
    return O.fixed_batches(p, 8, [F.col("example_id")]).select("example_id", "row_index", "batch")


def q_batch_counts(spark, sf):
    p = _predictions(spark, sf)
    return p.agg(F.count(F.lit(1)).alias("examples")).select(
        "examples", O.batch_count(F.col("examples"), 8, 1).alias("batches"),
        O.batch_count(F.col("examples"), 8, 2).alias("batches_accum2"))


# --- ordering and top-k -------------------------------------------------------

def q_top_repositories(spark, sf):
    r = S.repositories(spark, sf)
    return O.top_repositories(r, 100, "AUTOMOBILE")


def q_drop_rows(spark, sf):
    f = S.files(spark, sf).select("filename")
    return O.drop_rows(f, 5, [F.col("filename")])


def q_number_rows(spark, sf):
    f = S.files(spark, sf).select("filename")
    return O.number_rows(f, [F.col("filename")])


def q_preview(spark, sf):
    p = _predictions(spark, sf).select("example_id", "gold")
    return O.top_n(p, 5, [F.col("example_id")])


# --- training-log windows -----------------------------------------------------

def q_trailing_mean_loss(spark, sf):
    return L.trailing_mean(S.train_log(spark, sf), 100, 100)


def q_best_checkpoint(spark, sf):
    return L.best_checkpoint(S.epochs(spark, sf))


def q_running_totals(spark, sf):
    return L.running_totals(S.train_log(spark, sf))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


# --- sink -> source round trips (written under the session's checkpoint folder) ---

def _io_dir(spark, name):
    import uuid

    from corpusmill.session import checkpoint_dir
    return f"{checkpoint_dir(spark)}/corpusmill-io/{name}-{uuid.uuid4().hex}"


def q_token_docs_roundtrip(spark, sf):
    """SNK1 -> SRC2/PRJ2/PRJ3: gzip JSONL batches, two id fields."""
    from corpusmill.sources import readers as R
    from corpusmill.sources import sinks as W
    f = S.files(spark, sf)
    docs = TOK.tokenize_regex(f).select("filename", "project", "tokens")
    out = _io_dir(spark, "tokens")
    W.write_token_docs(docs, out, 4, id_cols=["project"])
    back = R.read_token_docs(spark, directory=out, id_fields=["filename", "project"])
    return back.select("id", F.size("tokens").alias("n_tokens"))


def q_stream_token_index(spark, sf):
    """Structured Streaming ingestion of token batches into the bag index."""
    from corpusmill.sources import sinks as W
    from corpusmill.streaming.token_stream import start_index, token_doc_stream
    f = S.files(spark, sf)
    docs = TOK.tokenize_regex(f).select("filename", "tokens")
    src = _io_dir(spark, "stream-src")
    W.write_token_docs(docs, src, 4)
    out = _io_dir(spark, "stream-out")
    q = start_index(token_doc_stream(spark, src), out, out + "-checkpoint")
    q.awaitTermination()
    return spark.read.parquet(out).select(F.col("id").alias("filename"), "n", "k")


def q_split_roundtrip(spark, sf):
    """SNK4 -> SRC4: one CSV folder per set with the reference header."""
    from corpusmill.sources import readers as R
    from corpusmill.sources import sinks as W
    out = _io_dir(spark, "sets")
    W.write_splits(_splits(spark, sf), out)
    parts = [R.read_split(spark, f"{out}/set={s}").withColumn("set", F.lit(s)) for s in SP.SET_NAMES]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.select("set", "repo_name", "filename")


def q_tasks_roundtrip(spark, sf):
    """SNK5 -> SRC5: JSONL tasks per set."""
    from corpusmill.sources import readers as R
    from corpusmill.sources import sinks as W
    out = _io_dir(spark, "tasks")
    W.write_tasks(_tasks(spark, sf), out)
    parts = [R.read_tasks(spark, f"{out}/set={s}").withColumn("set", F.lit(s)) for s in TK.EVAL_SETS]
    t = parts[0].unionByName(parts[1])
    return t.select("set", "groundTruth", F.md5("leftContext").alias("left_md5"),
                    F.md5("rightContext").alias("right_md5"))


def q_clusters_roundtrip(spark, sf):
    """SNK3 -> SRC7: one JSON object with cluster and member per line."""
    from corpusmill.sources import readers as R
    from corpusmill.sources import sinks as W
    out = _io_dir(spark, "clusters")
    W.write_clusters(G.cluster_members(_components(spark, sf)), out)
    return R.read_clusters(spark, out)


def q_clusters_document(spark, sf):
    """SNK3 -> SRC7: one JSON array of all clusters, names with brackets and quotes in them."""
    from corpusmill.sources import readers as R
    from corpusmill.sources import sinks as W
    out = _io_dir(spark, "document")
    named = _components(spark, sf).withColumn("node", F.concat(F.lit('f["'), F.col("node"), F.lit('"],\\.py')))
    W.write_cluster_document(G.cluster_lists(named), out)
    return R.read_cluster_lists(spark, out, single_document=True).select("cluster_index", F.explode("members").alias("member"))


def q_sequences_roundtrip(spark, sf):
    """SNK6 -> SRC6: sequence lines, leading marker dropped on read."""
    from corpusmill.sources import readers as R
    from corpusmill.sources import sinks as W
    out = _io_dir(spark, "seqs")
    W.write_sequences(_seqs(spark, sf), out)
    back = R.read_sequences(spark, out)
    return back.select(F.md5("source").alias("source_md5"), F.length("source").alias("source_len"))


def q_nonblank_lines(spark, sf):
    """SRC8 over the file contents written as text."""
    from corpusmill.sources import readers as R
    out = _io_dir(spark, "lines")
    S.files(spark, sf).select(F.col("content").alias("value")).write.text(out)
    return R.read_nonblank_lines(spark, out)


def q_predictions_sink(spark, sf):
    """SNK7: stripped predictions in example order."""
    from corpusmill.sources import sinks as W
    out = _io_dir(spark, "preds")
    W.write_predictions(_predictions(spark, sf), out)
    return spark.read.text(out)


QUERIES.update({
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn) and name[2:] not in QUERIES
})
