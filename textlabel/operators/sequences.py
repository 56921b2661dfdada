"""Document shaping: sentences -> padded token ids (ARR2-ARR7, AG10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import ensure_checkpoint_dir
from .vocab import build_vocabulary, index_tokens


def prepare_documents(df: DataFrame, text: str = "text", key: str = "doc_id",
                      n_sentences: int | None = 12, max_words: int = 20) -> DataFrame:
    """Text -> cleaned -> forced sentences -> padded/cut to ``n_sentences`` -> tokens.

    One projection, no shuffle: STR1-STR3, STR7, ARR1, STR9, STR10. With ``n_sentences=None`` nothing is cut or
    padded: all sentences of the whole text, for frequencies, vocabularies and embeddings.
    """
    chunks = df.select(key, T.force_sentences(T.clean_text(text), max_words).alias("_chunks"))
    if n_sentences is None:
        return chunks.select(key, F.col("_chunks").alias("sentences")).withColumn("tokens", T.tokenize_sentences("sentences"))
    # pad_truncate reads the chunks twice: keep them behind a projection boundary
    return chunks.select(key, T.pad_truncate("_chunks", n_sentences).alias("sentences")).withColumn(
        "tokens", T.tokenize_sentences("sentences"))


def shape_maxima(df: DataFrame, ids: str = "ids") -> DataFrame:
    """AG10: the longest document (sentences) and the longest sentence (tokens): one row."""
    return df.agg(
        F.max(F.size(ids)).alias("max_sentences"),
        F.max(F.array_max(F.transform(F.col(ids), lambda s: F.size(s)))).alias("max_tokens"))


def _left_pad(arr: Column, length: Column, pad: Column) -> Column:
    return F.concat(F.array_repeat(pad, F.greatest(length - F.size(arr), F.lit(0))), arr)


def numericalize(indexed: DataFrame, ids: str = "ids", pad_idx: int = 1,
                 out: str = "cube", maxima: DataFrame | None = None) -> DataFrame:
    """ARR2-ARR4: left-pad every sentence to the longest sentence and every document with
    all-pad sentences to the longest document. The two maxima are one aggregated row,
    joined by broadcast (a 1-row side). The id lookup keeps the token arrays' shape, so
    ``maxima`` may come from the (already materialised) token table instead of a second
    pass over the ids."""
    maxima = maxima if maxima is not None else shape_maxima(indexed, ids)
    pad = F.lit(pad_idx)
    padded_sent = F.transform(F.col(ids), lambda s: _left_pad(s, F.col("max_tokens"), pad))
    pad_sentence = F.array_repeat(pad, F.col("max_tokens"))
    cube = F.concat(
        F.array_repeat(pad_sentence, F.greatest(F.col("max_sentences") - F.size(ids), F.lit(0))),
        padded_sent)
    return (indexed.crossJoin(F.broadcast(maxima))
            .withColumn(out, cube).drop("max_sentences", "max_tokens"))


def sequence_features(df: DataFrame, text: str = "text", key: str = "doc_id",
                      n_sentences: int = 12, max_words: int = 20, fit_on: DataFrame | None = None, only: DataFrame | None = None):
    """Pipeline 3.2 front half: documents -> (vocabulary, padded id cube per document).

    ``fit_on``: build the vocabulary on these prepared rows only (quirk Q5); default all rows. ``only``: cubes of the documents with these keys only;
    vocabulary and maxima are still those of all rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # prepared once: the vocabulary, the maxima and the lookup read it
    prepared = prepare_documents(df, text, key, n_sentences, max_words).select(key, "tokens").checkpoint(eager=True)
    vocab = build_vocabulary(fit_on if fit_on is not None else prepared)
    indexed = index_tokens(prepared if only is None else prepared.join(only.select(key), key, "left_semi"), vocab, key)
    return vocab, numericalize(indexed, maxima=shape_maxima(prepared, "tokens"))


def encode_fixed(ids: Column, max_length: int = 512, cls_id: int = 2, sep_id: int = 3,
                 pad_id: int = 1) -> tuple[Column, Column]:
    """ARR5 + ARR6: [cls] + ids cut to max_length-2 + [sep], padded to max_length, with every
    pad id moved to the front; the mask is 0 for those leading pads, 1 after."""
    body = F.slice(ids, 1, max_length - 2)
    seq = F.concat(F.array(F.lit(cls_id)), body, F.array(F.lit(sep_id)))
    n_pad = F.lit(max_length) - F.size(F.filter(seq, lambda x: x != pad_id))
    front = F.concat(F.array_repeat(F.lit(pad_id), n_pad), F.filter(seq, lambda x: x != pad_id))
    mask = F.concat(F.array_repeat(F.lit(0), n_pad), F.array_repeat(F.lit(1), F.lit(max_length) - n_pad))
    return front, mask
