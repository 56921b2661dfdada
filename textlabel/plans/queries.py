"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator of the survey.

Every query reads the driver tables (whole tables, whole texts). Doubles are rounded on
output so the SQL oracle can be compared value by value; nested arrays are reported as an
md5 of a joined string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import jsonparse as J
from ..functions import labels as L
from ..functions import text as T
from ..operators import answers as A
from ..operators import evaluate as E
from ..operators import features as FE
from ..operators import lookup as LK
from ..operators import profile as P
from ..operators import prompts as PR
from ..operators import sampling as S
from ..operators import sequences as SQ
from ..operators import vocab as V
from ..sources.corpus import read_table, read_word_vectors
from . import inputs as I

LABELS = I.LABELS


def _r(c, n=6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def _md5_nested(c: Column) -> Column:
    return F.md5(F.array_join(F.transform(c, lambda s: F.array_join(s.cast("array<string>"), " ")), "|"))


# ---- scans, projections, labels ----------------------------------------------------------

def scan_project(spark, d):
    return I.labelled_yn(spark, d).select("doc_id", "text", "quality", "toxic")


def label_encode_strict(spark, d):
    df = I.all_docs_yn(spark, d)
    return df.select("doc_id", *[L.encode_strict(c).alias(c) for c in LABELS])


def label_encode_lenient(spark, d):
    df = I.all_docs_yn(spark, d)
    return df.select("doc_id", *[L.encode_lenient(c).alias(c) for c in LABELS])


def frame_replace(spark, d):
    df = I.labelled_yn(spark, d).select("doc_id", "text", *LABELS)
    return L.frame_replace(df, LABELS)


def label_vector(spark, d):
    df = I.labelled_int(spark, d)
    vec = L.label_vector(LABELS)
    return df.select("doc_id", F.array_join(vec.cast("array<string>"), ",").alias("label_vec"),
                     F.size(vec).alias("vec_size"), L.label_vector(["quality"]).alias("quality_scalar"))


def text_length(spark, d):
    return I.documents(spark, d).select("doc_id", T.text_length("text").cast("long").alias("text_length"))


def threshold_predict(spark, d):
    c = I.scored_cells(spark, d)
    return c.select("doc_id", "trait", _r("logit").alias("logit"), _r("score").alias("score"),
                    L.threshold("score").alias("predicted"))


# ---- text ------------------------------------------------------------------------------

def clean_text(spark, d):
    return I.documents(spark, d).select("doc_id", T.clean_text("text").alias("clean"))


def expand_contractions(spark, d):
    df = I.with_contraction_prefix(I.documents(spark, d))
    return df.select("doc_id", T.expand_contractions(F.lower("text")).alias("expanded"))


def word_count(spark, d):
    return I.documents(spark, d).select("doc_id", T.word_count("text").cast("long").alias("n_words"))


def force_sentences(spark, d):
    s = T.force_sentences(T.clean_text("text"))
    return I.documents(spark, d).select("doc_id", s.alias("s")).select(
        "doc_id", F.size("s").cast("long").alias("n_chunks"), F.md5(F.array_join("s", "|")).alias("chunks_md5"))


def sentence_split(spark, d):
    s = T.split_sentences(T.clean_text("text"))
    return I.documents(spark, d).select("doc_id", s.alias("s")).select(
        "doc_id", F.size("s").cast("long").alias("n_sentences"), F.md5(F.array_join("s", "|")).alias("sentences_md5"))


def _prepared(spark, d):
    return SQ.prepare_documents(I.documents(spark, d))


def _prepared_once(spark, d):
    """The prepared table when a query reads it twice (vocabulary + lookup): written once
    to the checkpoint folder (at most 12 x 20 words per document), lineage cut."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return _prepared(spark, d).checkpoint(eager=True)


def _whole(spark, d):
    """Tokens of all sentences of the whole texts."""
    return SQ.prepare_documents(I.documents(spark, d), n_sentences=None).drop("sentences")


def pad_truncate(spark, d):
    p = _prepared(spark, d)
    return p.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"),
                    F.md5(F.array_join("sentences", "|")).alias("sentences_md5"))


def tokenize_basic(spark, d):
    p = _prepared(spark, d)
    return p.select("doc_id", F.size(F.flatten("tokens")).cast("long").alias("n_tokens"),
                    _md5_nested(F.col("tokens")).alias("tokens_md5"))


def bow_tokens(spark, d):
    df = I.documents(spark, d).select("doc_id", T.bow_tokens("text").alias("t"))
    return df.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


# ---- vocabulary and ids ----------------------------------------------------------------------

def token_freq(spark, d):
    return V.token_counts(_whole(spark, d)).select("token", F.col("n").cast("long"))


def vocabulary(spark, d):
    return V.build_vocabulary(_whole(spark, d)).select("token", F.col("idx").cast("long"), "n")


def _indexed(spark, d, with_prepared: bool = False):
    p = _prepared_once(spark, d)
    vocab = V.build_vocabulary(p)
    ix = V.index_tokens(p, vocab)
    return (ix, p) if with_prepared else ix


def token_index(spark, d):
    ix = _indexed(spark, d)
    return ix.select("doc_id", F.size(F.flatten("ids")).cast("long").alias("n_ids"),
                     _md5_nested(F.col("ids")).alias("ids_md5"))


def numericalize(spark, d):
    ix, p = _indexed(spark, d, with_prepared=True)
    cube = SQ.numericalize(ix, maxima=SQ.shape_maxima(p, "tokens"))
    return cube.select("doc_id", F.size("cube").cast("long").alias("n_sentences"),
                       F.size(F.col("cube")[0]).cast("long").alias("sentence_len"),
                       _md5_nested(F.col("cube")).alias("cube_md5"))


def shape_maxima(spark, d):
    return SQ.shape_maxima(_indexed(spark, d)).select(
        F.col("max_sentences").cast("long"), F.col("max_tokens").cast("long"))


def top_words(spark, d):
    return P.top_words(_whole(spark, d), "tokens", k=50, stop_words=["<pad>"]).select(
        "word", F.col("n").cast("long"))


def _encode_inputs(spark, d):
    # vocabulary over the whole texts; each document is then cut to max_length - 2 tokens. Tokenised once
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    docs = I.documents(spark, d).select("doc_id", T.basic_english_tokens("text").alias("tok")).checkpoint(eager=True)
    vocab = V.build_vocabulary(docs.select(F.col("tok").alias("tokens")),
                               specials=("<unk>", "<pad>", "[CLS]", "[SEP]"))
    ids = V.index_tokens(docs.select("doc_id", F.array(F.slice("tok", 1, 510)).alias("tokens")), vocab)
    return ids.select("doc_id", F.coalesce(F.col("ids")[0], F.array().cast("array<int>")).alias("ids"))


def encode_fixed(spark, d):
    ids = _encode_inputs(spark, d)
    front, mask = SQ.encode_fixed(F.col("ids"), max_length=512, cls_id=2, sep_id=3, pad_id=1)
    return ids.select("doc_id", front.alias("input_ids"), mask.alias("mask")).select(
        "doc_id", F.md5(F.array_join("input_ids", " ")).alias("ids_md5"),
        F.md5(F.array_join("mask", "")).alias("mask_md5"),
        F.size(F.filter("mask", lambda x: x == 0)).cast("long").alias("n_pad"))


def sequence_dataset(spark, d):
    """Raw text to the padded cube of ids, with the label vector and the exact split of the labelled rows."""
    lab = I.labelled_int(spark, d)
    vocab, cube = SQ.sequence_features(I.documents(spark, d), only=lab.select("doc_id"))
    vec = F.array_join(L.label_vector(LABELS).cast("array<string>"), ",")
    split = S.exact_split(lab.select("doc_id"), "doc_id", seed=42, rule="halves")
    return (cube.join(lab.select("doc_id", vec.alias("label_vec")), "doc_id").join(split, "doc_id")
            .select("doc_id", _md5_nested(F.col("cube")).alias("cube_md5"), "label_vec", "split"))


# ---- bag of words ------------------------------------------------------------------------------

def _bow_split(spark, d):
    lab = I.labelled_int(spark, d).select("doc_id", "text", *LABELS)
    return S.train_test_split(lab, "doc_id", seed=42, test_size=0.2).withColumn(
        "tokens", T.bow_tokens("text"))


def bow_counts(spark, d):
    return FE.bow_counts_fitted(_bow_split(spark, d)).select("doc_id", "token", F.col("tf").cast("long"))


def bow_scale_stats(spark, d):
    # every term of a training row is in the training vocabulary: no vocabulary join needed
    train = _bow_split(spark, d).filter(F.col("split") == "train")
    n_train = train.agg(F.count(F.lit(1)).alias("n"))
    counts = train.select("doc_id", F.explode("tokens").alias("token")).groupBy("doc_id", "token").agg(
        F.count(F.lit(1)).alias("tf"))
    st = FE.bow_scale_stats(counts, n_train)
    return st.select("token", F.col("df").cast("long"), _r("s1").alias("s1"), _r("s2").alias("s2"),
                     _r("std").alias("std"), _r("scale").alias("scale"))


# ---- profiling ---------------------------------------------------------------------------------

def _profile_frame(spark, d):
    lab = read_table(spark, d, "labels").select("doc_id", "quality", "toxic")
    return read_table(spark, d, "documents").join(lab, "doc_id", "left").select(
        "doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")


def frame_info(spark, d):
    return P.frame_info(_profile_frame(spark, d)).select("column_name", "dtype", F.col("non_null").cast("long"))


def null_counts(spark, d):
    return P.null_counts(_profile_frame(spark, d)).select("column_name", F.col("n_missing").cast("long"))


def label_value_counts(spark, d):
    out = P.label_value_counts(I.labelled_yn(spark, d), LABELS)
    return out.select("value", *[F.col(c).cast("long") for c in LABELS])


def label_counts_long(spark, d):
    out = P.label_counts_long(I.labelled_yn(spark, d), LABELS)
    return out.select("value", "trait", F.col("count").cast("long"))


def label_corr(spark, d):
    df = L.frame_replace(I.labelled_yn(spark, d).select("doc_id", "text", *LABELS), LABELS)
    return P.label_corr(df, LABELS).select("trait_a", "trait_b", _r("corr").alias("corr"))


def length_label_corr(spark, d):
    return P.length_label_corr(I.labelled_int(spark, d), LABELS).select("trait", _r("corr").alias("corr"))


def length_describe(spark, d):
    out = P.describe_length(I.documents(spark, d))
    return out.select(*[_r(c).alias(c) for c in out.columns])


def length_boxplot(spark, d):
    out = P.length_boxplot(I.documents(spark, d))
    return out.select(*[_r(c).alias(c) for c in ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"]],
                      F.col("n_outliers").cast("long"))


# ---- evaluation ------------------------------------------------------------------------------

def micro_accuracy(spark, d):
    return E.micro_accuracy(I.run_cells(spark, d), ["run"]).select(
        F.col("run").cast("long"), _r("accuracy").alias("accuracy"))


def trait_accuracy(spark, d):
    return E.trait_accuracy(I.run_cells(spark, d), ["run"]).select(
        F.col("run").cast("long"), "trait", _r("accuracy").alias("accuracy"))


def confusion_counts(spark, d):
    return E.confusion_counts(I.run_cells(spark, d), ["run"]).select(
        F.col("run").cast("long"), "trait", *[F.col(c).cast("long") for c in ["tp", "fp", "fn", "tn"]])


def precision_recall(spark, d):
    return E.precision_recall(I.run_cells(spark, d), ["run"]).select(
        F.col("run").cast("long"), "trait", _r("precision").alias("precision"), _r("recall").alias("recall"))


def run_average_metrics(spark, d):
    m = E.run_average_metrics(E.metric_table(I.run_cells(spark, d)))
    return m.select("metric", "trait", _r("value").alias("value"), F.col("n_runs").cast("long"))


def drop_last_accuracy(spark, d):
    lab = I.labelled_int(spark, d).select("doc_id")
    test = S.exact_split(lab, "doc_id", seed=42, rule="halves").filter(F.col("split") == "test")
    kept = S.batch_positions(test.select("doc_id"), batch_size=32, seed=7, drop_last=True)
    cells = I.run_cells(spark, d).filter(F.col("run") == 1).join(kept.select("doc_id"), "doc_id", "left_semi")
    out = E.accuracy_rollup(cells)
    return out.select("trait", _r("accuracy").alias("accuracy"), F.col("n_rows").cast("long"))


def sequence_scores(spark, d):
    """Encoded sequences scored by a fitted model, row by row through ``batch_infer``: logits, threshold, accuracy of the full test batches."""
    from ..operators import wordvotes
    from ..operators.inference import batch_infer
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    ids = _encode_inputs(spark, d)
    front, mask = SQ.encode_fixed(F.col("ids"), max_length=512, cls_id=2, sep_id=3, pad_id=1)
    lab = I.labelled_int(spark, d).select("doc_id", *LABELS)
    rows = ids.select("doc_id", front.alias("input_ids"), mask.alias("mask")).join(lab, "doc_id")
    rows = rows.join(S.exact_split(lab.select("doc_id"), "doc_id", seed=42, rule="halves"), "doc_id").checkpoint(eager=True)
    words = F.filter("input_ids", lambda x: x >= 4).cast("array<string>")
    votes, priors = wordvotes.word_votes(rows.filter("split = 'train'").select(words.alias("tokens"), *LABELS), LABELS)
    test = rows.filter("split = 'test'")
    kept = S.batch_positions(test.select("doc_id"), batch_size=32, seed=7, drop_last=True)
    asked = test.join(kept.select("doc_id"), "doc_id", "left_semi")
    answers = batch_infer(asked, lambda: wordvotes.SequenceVotes(votes, priors, LABELS), prompt=["input_ids", "mask"], wait_min=0.0, wait_max=0.0)
    sums = F.from_json("raw", "array<long>")
    cells = [F.struct(F.lit(c).alias("trait"), F.col(c).cast("double").alias("actual"),
                      L.threshold(L.sigmoid(sums[j] / F.lit(1e6))).cast("double").alias("predicted")) for j, c in enumerate(LABELS)]
    out = E.accuracy_rollup(answers.join(asked.select("doc_id", *LABELS), "doc_id").select("doc_id", F.explode(F.array(*cells)).alias("c")).select("doc_id", "c.*"))
    return out.select("trait", _r("accuracy").alias("accuracy"), F.col("n_rows").cast("long"))


def batch_mean_loss(spark, d):
    out = E.batch_mean_loss(I.batch_log(spark, d), ["run", "epoch"])
    return out.select(F.col("run").cast("long"), F.col("epoch").cast("long"),
                      _r("epoch_loss").alias("epoch_loss"), F.col("n_batches").cast("long"))


def bce_loss(spark, d):
    out = E.bce_losses(I.scored_cells(spark, d))
    return out.select(_r("bce").alias("bce"), _r("bce_double_sigmoid").alias("bce_double_sigmoid"))


def best_epoch_trace(spark, d):
    t = E.best_epoch_trace(I.epoch_log(spark, d))
    return t.select(F.col("run").cast("long"), F.col("epoch").cast("long"),
                    "best_loss_so_far", "best_acc_so_far")


def best_epoch(spark, d):
    b = E.best_epoch(I.epoch_log(spark, d))
    return b.select(F.col("run").cast("long"), F.col("best_loss_epoch").cast("long"), _r("best_loss").alias("best_loss"),
                    F.col("best_acc_epoch").cast("long"), _r("best_acc").alias("best_acc"))


# ---- samples and splits -------------------------------------------------------------------------

def split_hash(spark, d):
    return S.hash_split(I.documents(spark, d).select("doc_id"), "doc_id", seed=42)


def split_exact(spark, d):
    return S.exact_split(I.labelled_int(spark, d).select("doc_id"), "doc_id", seed=42, rule="halves")


def split_exact_bert(spark, d):
    return S.exact_split(I.labelled_int(spark, d).select("doc_id"), "doc_id", seed=42, rule="fixed")


def split_train_test(spark, d):
    return S.train_test_split(I.labelled_int(spark, d).select("doc_id"), "doc_id", seed=42, test_size=0.2)


def sample_fraction(spark, d):
    return S.sample_fraction(I.labelled_int(spark, d).select("doc_id"), 0.15, "doc_id", seed=42)


def sample_examples(spark, d):
    return S.sample_examples(I.labelled_yn(spark, d).select("doc_id", "text", *LABELS), 4, "doc_id", seed=1)


# ---- prompts ---------------------------------------------------------------------------------------

def zeroshot_prompt(spark, d):
    return PR.zero_shot_prompts(I.labelled_yn(spark, d), I.TRAITS)


def _fewshot(spark, d, k, seed, budget, style="chat"):
    lab = I.labelled_yn(spark, d)
    ex = S.sample_examples(lab, k, "doc_id", seed=seed)
    return PR.few_shot_prompts(lab, ex, I.TRAITS, LABELS, seed=seed, budget=budget, style=style)


def fewshot_prompt(spark, d):
    out = _fewshot(spark, d, 2, 1, PR.DEFAULT_BUDGET)
    return out.select("doc_id", "prompt", F.col("n_tokens").cast("long"), "over_budget")


def fewshot_prompt_rules(spark, d):
    return _fewshot(spark, d, 1, 2, None, style="rules").select("doc_id", "prompt")


def prompt_budget(spark, d):
    out = _fewshot(spark, d, 2, 3, 4000)
    return out.select("doc_id", F.col("n_tokens").cast("long"), "over_budget", F.md5("prompt").alias("prompt_md5"))


def chat_messages(spark, d):
    return PR.chat_messages(zeroshot_prompt(spark, d))


def label_json(spark, d):
    lab = I.labelled_yn(spark, d)
    return lab.select("doc_id", J.label_json([L.encode_lenient(c) for c in LABELS], LABELS).alias("label_json"))


# ---- inference and answers -----------------------------------------------------------------------

def batch_infer_stub(spark, d):
    """Answers by a rule on columns, for the queries that parse answers."""
    return I.ruled_answers(zeroshot_prompt(spark, d))


def batch_infer_model(spark, d):
    """ML4, ML5, UDF5: a model that Spark fits on the labelled texts answers for every document, through a store that can be resumed."""
    from uuid import uuid4

    from ..operators import ledger, wordvotes
    from ..session import ensure_checkpoint_dir
    train = I.labelled_int(spark, d).select(T.bow_tokens("text").alias("tokens"), *LABELS)
    votes, priors = wordvotes.word_votes(train, LABELS)
    asked = I.documents(spark, d).select("doc_id", F.array_distinct(T.bow_tokens("text")).alias("words"))
    store = f"{ensure_checkpoint_dir(spark).rstrip('/')}/answers-{uuid4().hex}"
    return ledger.answer_all(asked, lambda: wordvotes.WordVotes(votes, priors, LABELS), store, prompt="words", wait_min=0.0, wait_max=0.0)


def answer_json(spark, d):
    a = batch_infer_stub(spark, d)
    return a.select("doc_id", J.extract_braces(T.strip("raw")).alias("json"))


def answer_json_split(spark, d):
    a = batch_infer_stub(spark, d)
    return a.select("doc_id", J.extract_braces_split(T.strip("raw")).alias("json"))


def answer_parse(spark, d):
    p = A.parse_answers(batch_infer_stub(spark, d), LABELS)
    return p.select("doc_id", "parse_ok", *[F.col(c).alias(c) for c in LABELS])


def answers_kept(spark, d):
    p = A.parse_answers(batch_infer_stub(spark, d), LABELS)
    return A.kept_rows(I.labelled_yn(spark, d).select("doc_id", *LABELS), p)


def answers_missed(spark, d):
    p = A.parse_answers(batch_infer_stub(spark, d), LABELS)
    return A.missed_rows(I.labelled_yn(spark, d).select("doc_id", *LABELS), p)


def miss_rate(spark, d):
    p = A.parse_answers(batch_infer_stub(spark, d), LABELS)
    return A.miss_counts(p).select(F.col("n_missed").cast("long"), F.col("n_total").cast("long"),
                                   _r("miss_rate").alias("miss_rate"))


def _experiment(spark, d, **kw):
    from .pipelines import experiment_ledger
    return experiment_ledger(I.labelled_yn(spark, d), I.TRAITS, LABELS, lambda p: I.ruled_answers(p, by=("run",)), **kw)


def _metrics(ledger):
    from .pipelines import experiment_metrics
    out = experiment_metrics(ledger, LABELS)
    return out.select("metric", "trait", _r("value").alias("value"), F.col("n_runs").cast("long"))


def prompt_experiment(spark, d, frac: float = 0.5, runs: int = 3, k: int = 1):
    """ML7: sample -> per run: examples, prompts, answers, parse, keep -> metrics -> mean."""
    return _metrics(_experiment(spark, d, frac=frac, runs=runs, example_count=k))


def rules_experiment(spark, d):
    """ML7 in the rules form: 15 % of the rows, five runs, answers cut by the split rule."""
    return _metrics(_experiment(spark, d, frac=0.15, runs=5, style="rules", cut="split"))


def experiment_fates(spark, d):
    """AG18: what became of every sampled row in every run, with a budget that some prompts exceed."""
    from .pipelines import experiment_fates as fates
    out = fates(_experiment(spark, d, frac=0.5, runs=3, budget=500))
    return out.select(F.col("run").cast("long"), "fate", F.col("n").cast("long"), _r("share").alias("share"))


def experiment_missed(spark, d):
    """Every row of the rules form without a usable answer, by run, with the cause."""
    from .pipelines import missed_rows
    return missed_rows(_experiment(spark, d, frac=0.15, runs=5, style="rules", cut="split")).select(F.col("run").cast("long"), "doc_id", "fate")


# ---- word vectors and embeddings ----------------------------------------------------------------------

EMB_DIM = 64


def _word_vectors(spark, d):
    vocab = V.build_vocabulary(_whole(spark, d))
    return FE.word_vectors(vocab, read_table(spark, d, "embeddings"), EMB_DIM)


def embed_lookup(spark, d):
    wv = _word_vectors(spark, d)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return wv.select("token", F.col("idx").cast("long"), "known", _r(total, 4).alias("vec_sum"),
                     _r(F.col("vector")[0]).alias("vec_first"))


def embed_by_word(spark, d):
    """Word vectors found by the word itself, read from a vector file (word, vector)."""
    from uuid import uuid4

    from ..session import ensure_checkpoint_dir
    vocab = V.build_vocabulary(_whole(spark, d))
    emb = read_table(spark, d, "embeddings")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/word-vectors-{uuid4().hex}"
    vocab.join(emb, vocab["idx"] == emb["vec_id"]).select(F.col("token").alias("word"), F.col("embedding").alias("vector")).write.parquet(path)
    words = read_word_vectors(spark, path)
    wv = FE.word_vectors(vocab, words, EMB_DIM, vec_key="word", vec_col="vector", on="word")
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return wv.select("token", F.col("idx").cast("long"), "known", _r(total, 4).alias("vec_sum"),
                     _r(F.col("vector")[0]).alias("vec_first"))


def embed_normalize(spark, d):
    wv = _word_vectors(spark, d).withColumn("u", FE.l2_normalize(F.col("vector")))
    norm = F.sqrt(F.aggregate("u", F.lit(0.0), lambda a, x: a + x * x))
    total = F.aggregate("u", F.lit(0.0), lambda a, x: a + x)
    return wv.select("token", F.col("idx").cast("long"), _r(norm).alias("norm"), _r(total, 5).alias("vec_sum"))


def _doc_embeddings(spark, d):
    p = LK.pack(_whole(spark, d), "doc_id", "tokens", FE.EMBED_ROWS)  # tokenised once
    vocab = V.build_vocabulary(p)
    return FE.doc_embeddings(p, vocab, read_table(spark, d, "embeddings"), EMB_DIM)


def doc_embedding(spark, d):
    e = _doc_embeddings(spark, d)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    return e.select("doc_id", _r(total, 5).alias("emb_sum"), _r(F.col("embedding")[0], 5).alias("emb_first"),
                    _r(norm, 5).alias("emb_norm"))


# ---- models (rows-only checks) -------------------------------------------------------------------------

def bow_pipeline_metrics(spark, d):
    from .pipelines import bag_of_words
    out = bag_of_words(I.labelled_yn(spark, d).select("doc_id", "text", *LABELS), LABELS)
    return out.select("metric", "trait", _r("value").alias("value"))


def bow_logreg(spark, d):
    """The fits themselves: features, and whether each optimum is reached (largest component of the gradient at most 1e-4 of that at the start)."""
    from .pipelines import bag_of_words_model
    model, _ = bag_of_words_model(I.labelled_yn(spark, d).select("doc_id", "text", *LABELS), LABELS)
    rows = [(lab, model.n_terms, m.converged and m.gradient <= 1e-4) for lab, m in model.fits.items()]
    return spark.createDataFrame(rows, "trait string, n_features long, at_optimum boolean")


def embed_logreg(spark, d):
    from .pipelines import embedding_classifier
    out = embedding_classifier(_doc_embeddings(spark, d), I.labelled_int(spark, d).select("doc_id", *LABELS), LABELS)
    return out.select("metric", "trait", _r("value").alias("value"))


def random_search(spark, d):
    from .pipelines import embedding_search
    out = embedding_search(_doc_embeddings(spark, d), I.labelled_int(spark, d).select("doc_id", *LABELS), LABELS)
    return out.select("trial", _r("reg_param").alias("reg_param"), "positive_weight", _r("val_loss").alias("val_loss"),
                      _r("val_acc").alias("val_acc"), "is_best")


QUERIES = {
    "scan_project": scan_project,
    "label_encode_strict": label_encode_strict,
    "label_encode_lenient": label_encode_lenient,
    "frame_replace": frame_replace,
    "label_vector": label_vector,
    "text_length": text_length,
    "threshold_predict": threshold_predict,
    "clean_text": clean_text,
    "expand_contractions": expand_contractions,
    "word_count": word_count,
    "force_sentences": force_sentences,
    "sentence_split": sentence_split,
    "pad_truncate": pad_truncate,
    "tokenize_basic": tokenize_basic,
    "bow_tokens": bow_tokens,
    "token_freq": token_freq,
    "vocabulary": vocabulary,
    "token_index": token_index,
    "numericalize": numericalize,
    "shape_maxima": shape_maxima,
    "top_words": top_words,
    "encode_fixed": encode_fixed,
    "sequence_dataset": sequence_dataset,
    "sequence_scores": sequence_scores,
    "bow_counts": bow_counts,
    "bow_scale_stats": bow_scale_stats,
    "frame_info": frame_info,
    "null_counts": null_counts,
    "label_value_counts": label_value_counts,
    "label_counts_long": label_counts_long,
    "label_corr": label_corr,
    "length_label_corr": length_label_corr,
    "length_describe": length_describe,
    "length_boxplot": length_boxplot,
    "micro_accuracy": micro_accuracy,
    "trait_accuracy": trait_accuracy,
    "confusion_counts": confusion_counts,
    "precision_recall": precision_recall,
    "run_average_metrics": run_average_metrics,
    "drop_last_accuracy": drop_last_accuracy,
    "batch_mean_loss": batch_mean_loss,
    "bce_loss": bce_loss,
    "best_epoch_trace": best_epoch_trace,
    "best_epoch": best_epoch,
    "split_hash": split_hash,
    "split_exact": split_exact,
    "split_exact_bert": split_exact_bert,
    "split_train_test": split_train_test,
    "sample_fraction": sample_fraction,
    "sample_examples": sample_examples,
    "zeroshot_prompt": zeroshot_prompt,
    "fewshot_prompt": fewshot_prompt,
    "fewshot_prompt_rules": fewshot_prompt_rules,
    "prompt_budget": prompt_budget,
    "chat_messages": chat_messages,
    "label_json": label_json,
    "batch_infer_stub": batch_infer_stub,
    "answer_json": answer_json,
    "answer_json_split": answer_json_split,
    "answer_parse": answer_parse,
    "answers_kept": answers_kept,
    "answers_missed": answers_missed,
    "miss_rate": miss_rate,
    "prompt_experiment": prompt_experiment,
    "rules_experiment": rules_experiment,
    "experiment_fates": experiment_fates,
    "experiment_missed": experiment_missed,
    "batch_infer_model": batch_infer_model,
    "embed_lookup": embed_lookup,
    "embed_by_word": embed_by_word,
    "embed_normalize": embed_normalize,
    "doc_embedding": doc_embedding,
    "bow_pipeline_metrics": bow_pipeline_metrics,
    "bow_logreg": bow_logreg,
    "embed_logreg": embed_logreg,
    "random_search": random_search,
}
