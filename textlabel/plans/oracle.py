"""DuckDB oracle SQL for the registered queries (same derivations as ``plans/inputs.py``).

The SQL is generated from the same fixed-value lists the Spark side uses (contractions,
tokenizer rules, prompt wording), so the two cannot drift apart. Float literals are cast to
DOUBLE: DuckDB would otherwise do exact DECIMAL arithmetic where Python/Spark use doubles.
"""

from __future__ import annotations

import re

from ..functions.text import BASIC_ENGLISH_RULES, CONTRACTIONS
from ..operators import prompts as PR
from . import inputs as I


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


D = "::DOUBLE"

LAB_YN = """lab AS (SELECT d.doc_id, d.text, d.n_chars,
  CASE WHEN l.quality = 1 THEN 'y' ELSE 'n' END AS quality,
  CASE WHEN l.toxic = 1 THEN 'y' ELSE 'n' END AS toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

LAB_INT = """labi AS (SELECT d.doc_id, d.text, d.n_chars, l.quality, l.toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

ALL_YN = """allyn AS (SELECT d.doc_id,
  CASE WHEN l.quality = 1 THEN 'y' WHEN l.quality = 0 THEN 'n' END AS quality,
  CASE WHEN l.toxic = 1 THEN 'y' WHEN l.toxic = 0 THEN 'n' END AS toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"


def expand(x: str) -> str:
    pattern = "(" + "|".join(re.escape(k) for k, _ in CONTRACTIONS) + ")"
    out = f"regexp_replace({x}, {q(pattern)}, chr(1) || '\\1' || chr(2), 'g')"
    for k, v in CONTRACTIONS:
        out = f"replace({out}, chr(1) || {q(k)} || chr(2), {q(v)})"
    return out


def clean(x: str) -> str:
    return f"regexp_replace({expand(f'lower({x})')}, '[^a-zA-Z0-9\\s.]', '', 'g')"


def force(x: str, k: int = 20) -> str:
    """x is already cleaned; returns the chunk list."""
    w = words(f"regexp_replace({x}, '[^a-zA-Z0-9\\s]', '', 'g')")
    return (f"(SELECT CASE WHEN len(ws) > 0 THEN list_transform(range(0, (len(ws) - 1) // {k} + 1), "
            f"lambda i: array_to_string(ws[i * {k} + 1 : i * {k} + {k}], ' ')) ELSE []::VARCHAR[] END "
            f"FROM (SELECT {w} AS ws))")


def pad12(x: str, n: int = 12) -> str:
    return (f"(CASE WHEN len({x}) < {n} THEN list_concat(list_transform(range({n} - len({x})), lambda i: '<pad>'), {x}) "
            f"ELSE {x}[1:{n}] END)")


def basic_tokens(x: str) -> str:
    line = f"lower({x})"
    for pattern, repl in BASIC_ENGLISH_RULES:
        line = f"regexp_replace({line}, {q(pattern)}, {q(repl)}, 'g')"
    return words(line)


def nested_md5(x: str) -> str:
    return f"md5(array_to_string(list_transform({x}, lambda s: array_to_string(s, ' ')), '|'))"


PREP = f"""prep0 AS (SELECT doc_id, {force(clean('text'))} AS chunks FROM documents),
prep AS (SELECT doc_id, {pad12('chunks')} AS sentences FROM prep0),
tok AS (SELECT doc_id, sentences, list_transform(sentences, lambda s: {basic_tokens('s')}) AS tokens FROM prep)"""

WHOLE = PREP.replace(pad12("chunks"), "chunks")  # all sentences of the whole text

FREQ = """freq AS (SELECT t AS token, count(*) AS n FROM (SELECT unnest(flatten(tokens)) AS t FROM tok) GROUP BY t)"""

VOCAB = """vocab AS (
  SELECT '<unk>' AS token, 0::BIGINT AS idx, NULL::BIGINT AS n UNION ALL
  SELECT '<pad>', 1::BIGINT, NULL::BIGINT UNION ALL
  SELECT token, (row_number() OVER (ORDER BY n DESC, token ASC) + 1)::BIGINT AS idx, n
  FROM freq WHERE token NOT IN ('<unk>', '<pad>'))"""

INDEXED = """cells AS (
  SELECT t.doc_id, s.si, x.ti, t.tokens[s.si][x.ti] AS token
  FROM tok t, LATERAL (SELECT unnest(range(1, len(t.tokens) + 1)) AS si) s,
       LATERAL (SELECT unnest(range(1, len(t.tokens[s.si]) + 1)) AS ti) x),
sent_ids AS (
  SELECT c.doc_id, c.si, list(coalesce(v.idx, 0) ORDER BY c.ti) AS ids
  FROM cells c LEFT JOIN vocab v ON c.token = v.token GROUP BY c.doc_id, c.si),
indexed AS (SELECT doc_id, list(ids ORDER BY si) AS ids FROM sent_ids GROUP BY doc_id)"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def logit_sql(trait: str) -> str:
    base = f"((n_chars - 1500){D} / 1000.0{D})"
    return base if trait == "quality" else f"(-{base})"


SCORED = """scored AS (
  SELECT doc_id, 'quality' AS trait, quality::DOUBLE AS actual, {lq} AS logit, 1.0::DOUBLE / (1.0::DOUBLE + exp(-{lq})) AS score FROM labi
  UNION ALL
  SELECT doc_id, 'toxic', toxic::DOUBLE, {lt}, 1.0::DOUBLE / (1.0::DOUBLE + exp(-{lt})) FROM labi)""".format(
    lq=logit_sql("quality"), lt=logit_sql("toxic"))

RUNCELLS = f"""rc AS (
  SELECT r.run, s.doc_id, s.trait, s.actual,
    CASE WHEN s.score >= (4 + r.run){D} / 10.0{D} THEN 1.0{D} ELSE 0.0{D} END AS predicted
  FROM scored s, (SELECT range AS run FROM range({I.N_RUNS})) r)"""


def metrics_sql(cells: str) -> str:
    """Per-run long metric table from a cells relation (run, doc_id, trait, actual, predicted)."""
    return f"""mt AS (
  SELECT run, 'overall_accuracy' AS metric, 'all' AS trait,
    avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END){D} AS value FROM {cells} GROUP BY run
  UNION ALL
  SELECT run, 'accuracy', trait, avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END){D} FROM {cells} GROUP BY run, trait
  UNION ALL
  SELECT run, 'precision', trait, CASE WHEN sum(CASE WHEN predicted = 1 THEN 1 ELSE 0 END) > 0
    THEN sum(CASE WHEN predicted = 1 AND actual = 1 THEN 1 ELSE 0 END){D} / sum(CASE WHEN predicted = 1 THEN 1 ELSE 0 END)
    ELSE 0.0{D} END FROM {cells} GROUP BY run, trait
  UNION ALL
  SELECT run, 'recall', trait, CASE WHEN sum(CASE WHEN (predicted = 1 OR predicted = 0) AND actual = 1 THEN 1 ELSE 0 END) > 0
    THEN sum(CASE WHEN predicted = 1 AND actual = 1 THEN 1 ELSE 0 END){D} / sum(CASE WHEN (predicted = 1 OR predicted = 0) AND actual = 1 THEN 1 ELSE 0 END)
    ELSE 0.0{D} END FROM {cells} GROUP BY run, trait)"""


def rank_sql(rel: str, seed, extra: str = "") -> str:
    """Seeded exact position and total, as ``sampling.ranked``."""
    return (f"SELECT *{extra}, row_number() OVER (ORDER BY md5('{seed}:' || doc_id::VARCHAR), doc_id) AS pos, "
            f"count(*) OVER () AS n FROM {rel}")


def tok_count(x: str) -> str:
    return f"len(regexp_extract_all({x}, '\\w+|[^\\w\\s]'))"


def label_block(indent: str, yn: bool = True) -> str:
    inner = indent + "    "
    keys = I.LABELS
    parts = [q(indent + "{\n")]
    for i, k in enumerate(keys):
        tail = "  " if i == len(keys) - 1 else ("," if i == 0 else ", ")
        val = f"(CASE WHEN {k} = 'y' THEN 1 ELSE 0 END)::VARCHAR" if yn else f"{k}::VARCHAR"
        parts += [q(f'{inner}"{k}": '), val, q(tail + "\n")]
    parts.append(q(indent + "}"))
    return " || ".join(parts)


def example_sql(style: str = "chat") -> str:
    pad = "        " if style == "chat" else "            "
    head = PR.CHAT_EXAMPLE_HEAD if style == "chat" else PR.RULES_EXAMPLE_HEAD.format(pad=pad)
    return f"{q(chr(10) + pad + head + chr(10) + pad + chr(34))} || text || {q(chr(34) + chr(10) + chr(10))} || {label_block(pad)} || {q(chr(10) + pad)}"


TARGET = f"{q(chr(10) + '    ' + PR.TARGET_HEAD + chr(10) + '    ')} || text || {q(chr(10) + '    ')}"
CHAT_HEADER = q(PR.chat_header(I.TRAITS))
RULES_HEADER = q(PR.rules_header(I.TRAITS))


def fewshot_sql(k: int, seed: int, budget, style: str = "chat") -> str:
    header = CHAT_HEADER if style == "chat" else RULES_HEADER
    ex = f"""ex AS (SELECT doc_id, text, quality, toxic, md5('{seed}:' || doc_id::VARCHAR) AS ok_key FROM lab
      ORDER BY md5('{seed}:' || doc_id::VARCHAR), doc_id LIMIT {k}),
exb AS (SELECT coalesce(string_agg(b, '' ORDER BY ok_key, doc_id), '') AS ex_text, coalesce(sum(bt), 0) AS ex_tok, count(*) AS n_ex
  FROM (SELECT ok_key, doc_id, {example_sql(style)} AS b, {tok_count(example_sql(style))} AS bt FROM ex))"""
    body = f"""fs AS (SELECT l.doc_id, {header} || exb.ex_text || ({TARGET}) AS p,
  {tok_count(header)} + exb.ex_tok + {tok_count(TARGET)} AS n_tokens, exb.n_ex FROM lab l, exb)"""
    return ex + ",\n" + body


STUB = """
  CASE WHEN doc_id % 7 = 0 THEN 'I am not able to tell from this essay.'
       WHEN doc_id % 7 = 1 THEN 'Result: {"quality": ' || sq || ', "toxic": ' || st
       WHEN doc_id % 7 = 2 THEN 'Sure!' || chr(10) || '{"quality": ' || sq || ',' || chr(10) || ' "toxic": ' || st || '} ok'
       WHEN doc_id % 7 = 3 THEN '{"quality": ' || sq || ', "toxic": ' || st || '}'
       WHEN doc_id % 7 = 4 THEN '{"quality": "' || sq || '", "toxic": ' || st || '}'
       WHEN doc_id % 7 = 5 THEN '{"quality": ' || sq || '} and {"toxic": ' || st || '}'
       ELSE '  {"quality": ' || (CASE WHEN sq = '1' THEN 'true' ELSE 'false' END) || ', "toxic": ' || st || ', "note": "x"}  '
  END"""


def stub_sql(prompts: str, passthrough: str = "") -> str:
    """Answers of the rule on columns (``inputs.ruled_answers``) for a relation with doc_id, p."""
    return f"""stubl AS (SELECT {passthrough} doc_id, p,
    CASE WHEN length(p) >= 2000 THEN '1' ELSE '0' END AS sq,
    CASE WHEN length(p) % 3 = 0 THEN '1' ELSE '0' END AS st FROM {prompts}),
ans AS (SELECT {passthrough} doc_id::BIGINT AS doc_id,
    CASE WHEN p IS NULL OR doc_id % 13 = 0 THEN NULL ELSE {STUB} END AS raw,
    CASE WHEN p IS NULL THEN 'no_prompt' WHEN doc_id % 13 = 0 THEN 'failed' ELSE 'ok' END AS status,
    (CASE WHEN p IS NULL THEN 0 WHEN doc_id % 13 = 0 THEN 3 WHEN doc_id % 11 = 0 THEN 2 ELSE 1 END)::INTEGER AS attempts
  FROM stubl)"""


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def greedy_sql(x: str) -> str:
    return f"nullif(regexp_extract({strip_sql(x)}, '(?s)\\{{.*\\}}', 0), '')"


def typed_sql(j: str, key: str) -> str:
    path = f"'$.{key}'"
    return (f"(CASE WHEN json_type({j}, {path}) = 'BOOLEAN' THEN (CASE WHEN json_extract({j}, {path})::BOOLEAN THEN 1.0 ELSE 0.0 END)::DOUBLE "
            f"WHEN json_type({j}, {path}) IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN json_extract({j}, {path})::DOUBLE END)")


def split_sql(x: str) -> str:
    s = strip_sql(x)
    rest = f"regexp_extract({s}, '(?s)\\{{(.*)', 1)"
    return (f"CASE WHEN strpos({s}, '{{') > 0 THEN '{{' || (CASE WHEN strpos({rest}, '}}') > 0 THEN regexp_extract({rest}, '(?s)^(.*)\\}}', 1) "
            f"ELSE {rest} END) || '}}' END")


def parsed_sql(ans: str, passthrough: str = "", cut: str = "greedy") -> str:
    return f"""pj AS (SELECT {passthrough} doc_id, status, CASE WHEN json_valid(j) THEN j END AS j FROM
    (SELECT {passthrough} doc_id, status, {greedy_sql('raw') if cut == "greedy" else split_sql('raw')} AS j FROM {ans})),
parsed AS (SELECT {passthrough} doc_id, status, coalesce(j IS NOT NULL AND len(json_keys(j)) > 0, false) AS parse_ok,
    CASE WHEN j IS NOT NULL THEN {typed_sql('j', 'quality')} END AS quality,
    CASE WHEN j IS NOT NULL THEN {typed_sql('j', 'toxic')} END AS toxic FROM pj)"""


ZS = f"zs AS (SELECT doc_id, {CHAT_HEADER} || ({TARGET}) AS p FROM lab)"

WORDVEC = f"""wv AS (SELECT v.token, v.idx, e.vec_id IS NOT NULL AS known,
  coalesce(e.embedding::DOUBLE[], list_transform(range(64), lambda dd: -0.25{D} + 0.5{D} *
    (('0x' || substr(md5('7:' || v.token || ':' || dd::VARCHAR), 1, 8))::BIGINT){D} / 4294967296.0{D})) AS vector
  FROM vocab v LEFT JOIN embeddings e ON e.vec_id = v.idx)"""

NORM = f"""wvn AS (SELECT token, idx, list_transform(vector, lambda x: x / greatest(sqrt(list_sum(list_transform(vector, lambda y: y * y))), 1e-12{D})) AS u FROM wv)"""

BOW_SPLIT = f"""bs AS (SELECT doc_id, CASE WHEN pos <= ceil(0.2{D} * n) THEN 'test' ELSE 'train' END AS split,
    regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS tokens
  FROM ({rank_sql('labi', 42)})),
bvocab AS (SELECT DISTINCT unnest(tokens) AS token FROM bs WHERE split = 'train'),
btf AS (SELECT doc_id, split, token, count(*) AS tf FROM (SELECT doc_id, split, unnest(tokens) AS token FROM bs) GROUP BY ALL)"""

EXACT_SPLIT = f"""es AS (SELECT doc_id, pos, n, floor(0.7{D} * n) AS ntr FROM ({rank_sql('labi', 42)}))"""

EPOCH = f"""elog AS (SELECT user_id AS run, event_id AS epoch, value AS val_loss, 1.0{D} / (1.0{D} + value) AS val_acc FROM events)"""


def sql_bce(x: str) -> str:
    return f"greatest({x}, 0.0{D}) - {x} * actual + ln(1.0{D} + exp(-abs({x})))"


ORACLE_SQL: dict[str, str] = {}


def _add(name: str, sql: str) -> None:
    ORACLE_SQL[name] = sql.strip()


_add("scan_project", w(LAB_YN) + "SELECT doc_id, text, quality, toxic FROM lab")
_add("label_encode_strict", w(ALL_YN) + """SELECT doc_id,
  (CASE WHEN quality IS NULL THEN NULL WHEN quality = 'y' THEN 1 WHEN quality = 'n' THEN 0 END)::INTEGER AS quality,
  (CASE WHEN toxic IS NULL THEN NULL WHEN toxic = 'y' THEN 1 WHEN toxic = 'n' THEN 0 END)::INTEGER AS toxic FROM allyn""")
_add("label_encode_lenient", w(ALL_YN) + """SELECT doc_id, coalesce(quality = 'y', false)::INTEGER AS quality,
  coalesce(toxic = 'y', false)::INTEGER AS toxic FROM allyn""")
_add("frame_replace", w(LAB_YN) + """SELECT doc_id, CASE WHEN text = 'y' THEN '1' WHEN text = 'n' THEN '0' ELSE text END AS text,
  (CASE WHEN quality = 'y' THEN 1 ELSE 0 END)::INTEGER AS quality, (CASE WHEN toxic = 'y' THEN 1 ELSE 0 END)::INTEGER AS toxic FROM lab""")
_add("label_vector", w(LAB_INT) + """SELECT doc_id, quality::FLOAT::VARCHAR || ',' || toxic::FLOAT::VARCHAR AS label_vec,
  2::INTEGER AS vec_size, quality::FLOAT AS quality_scalar FROM labi""")
_add("text_length", "SELECT doc_id, length(text)::BIGINT AS text_length FROM documents")
_add("threshold_predict", w(LAB_INT, SCORED) + """SELECT doc_id, trait, round(logit, 6) + 0.0 AS logit, round(score, 6) AS score,
  (score >= 0.5::DOUBLE)::INTEGER AS predicted FROM scored""")
_add("clean_text", f"SELECT doc_id, {clean('text')} AS clean FROM documents")
_prefixes = ", ".join(q(p) for p in I.CONTRACTION_PREFIXES)
_add("expand_contractions", f"""SELECT doc_id, {expand('lower(t)')} AS expanded FROM
  (SELECT doc_id, [{_prefixes}][doc_id % {len(I.CONTRACTION_PREFIXES)} + 1] || text AS t FROM documents)""")
_add("word_count", f"SELECT doc_id, len({words('text')})::BIGINT AS n_words FROM documents")
_add("force_sentences", f"""SELECT doc_id, len(s)::BIGINT AS n_chunks, md5(array_to_string(s, '|')) AS chunks_md5 FROM
  (SELECT doc_id, {force(clean('text'))} AS s FROM documents)""")
_SS = f"""flatten(list_transform(list_transform(regexp_split_to_array(cl, '\\.\\s+|\\.$'), lambda p: {words('p')}), lambda w:
    CASE WHEN len(w) < 20 THEN []::VARCHAR[]
         WHEN len(w) > 100 THEN list_transform(list_filter(list_transform(range(0, (len(w) - 1) // 50 + 1),
              lambda i: w[i * 50 + 1 : i * 50 + 50]), lambda ch: len(ch) >= 20), lambda ch: array_to_string(ch, ' '))
         ELSE [array_to_string(w, ' ')] END))"""
_add("sentence_split", f"""SELECT doc_id, len(s)::BIGINT AS n_sentences, md5(array_to_string(s, '|')) AS sentences_md5 FROM
  (SELECT doc_id, {_SS} AS s FROM (SELECT doc_id, {clean('text')} AS cl FROM documents))""")
_add("pad_truncate", w(PREP) + """SELECT doc_id, len(sentences)::BIGINT AS n_sentences,
  md5(array_to_string(sentences, '|')) AS sentences_md5 FROM prep""")
_add("tokenize_basic", w(PREP) + f"""SELECT doc_id, len(flatten(tokens))::BIGINT AS n_tokens, {nested_md5('tokens')} AS tokens_md5 FROM tok""")
_add("bow_tokens", """SELECT doc_id, len(t)::BIGINT AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM
  (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS t FROM documents)""")
_add("token_freq", w(WHOLE, FREQ) + "SELECT token, n::BIGINT AS n FROM freq")
_add("vocabulary", w(WHOLE, FREQ, VOCAB) + "SELECT token, idx, n FROM vocab")
_add("token_index", w(PREP, FREQ, VOCAB, INDEXED) + f"""SELECT doc_id, len(flatten(ids))::BIGINT AS n_ids, {nested_md5('ids')} AS ids_md5 FROM indexed""")
_add("numericalize", w(PREP, FREQ, VOCAB, INDEXED,
                       "mx AS (SELECT max(len(ids)) AS ms, max(list_max(list_transform(ids, lambda s: len(s)))) AS ml FROM indexed)",
                       """cube AS (SELECT doc_id, list_concat(list_transform(range(greatest(mx.ms - len(ids), 0)), lambda i: list_transform(range(mx.ml), lambda j: 1)),
      list_transform(ids, lambda s: list_concat(list_transform(range(greatest(mx.ml - len(s), 0)), lambda i: 1), s))) AS cube FROM indexed, mx)""")
     + f"SELECT doc_id, len(cube)::BIGINT AS n_sentences, len(cube[1])::BIGINT AS sentence_len, {nested_md5('cube')} AS cube_md5 FROM cube")
_add("shape_maxima", w(PREP, FREQ, VOCAB, INDEXED) + """SELECT max(len(ids))::BIGINT AS max_sentences,
  max(list_max(list_transform(ids, lambda s: len(s))))::BIGINT AS max_tokens FROM indexed""")
_add("top_words", w(WHOLE, FREQ) + "SELECT token AS word, n::BIGINT AS n FROM freq WHERE token <> '<pad>' ORDER BY n DESC, token ASC LIMIT 50")
_ENCODED = (
    f"eall AS (SELECT doc_id, {basic_tokens('text')} AS tk FROM documents)",
    "etok AS (SELECT doc_id, tk[1:510] AS tk FROM eall)",
    "efreq AS (SELECT t AS token, count(*) AS n FROM (SELECT unnest(tk) AS t FROM eall) GROUP BY t)",
    """evocab AS (SELECT * FROM (VALUES ('<unk>', 0), ('<pad>', 1), ('[CLS]', 2), ('[SEP]', 3)) v(token, idx) UNION ALL
      SELECT token, row_number() OVER (ORDER BY n DESC, token ASC) + 3 FROM efreq WHERE token NOT IN ('<unk>', '<pad>', '[CLS]', '[SEP]'))""",
    """ecells AS (SELECT e.doc_id, x.ti, e.tk[x.ti] AS token FROM etok e, LATERAL (SELECT unnest(range(1, len(e.tk) + 1)) AS ti) x)""",
    """eids AS (SELECT d.doc_id, coalesce(list(coalesce(v.idx, 0) ORDER BY c.ti) FILTER (WHERE c.ti IS NOT NULL), []) AS ids
      FROM documents d LEFT JOIN ecells c ON d.doc_id = c.doc_id LEFT JOIN evocab v ON c.token = v.token GROUP BY d.doc_id)""",
    """eseq AS (SELECT doc_id, list_filter(list_concat([2], ids[1:510], [3]), lambda x: x <> 1) AS body FROM eids)""")
_add("encode_fixed", w(*_ENCODED)
    + """SELECT doc_id, md5(array_to_string(list_concat(list_transform(range(512 - len(body)), lambda i: 1), body), ' ')) AS ids_md5,
  md5(array_to_string(list_concat(list_transform(range(512 - len(body)), lambda i: 0), list_transform(range(len(body)), lambda i: 1)), '')) AS mask_md5,
  (512 - len(body))::BIGINT AS n_pad FROM eseq""")
_add("bow_counts", w(LAB_INT, BOW_SPLIT) + "SELECT doc_id, token, tf::BIGINT AS tf FROM btf WHERE token IN (SELECT token FROM bvocab)")
_add("bow_scale_stats", w(LAB_INT, BOW_SPLIT, "ntr AS (SELECT count(*) AS n FROM bs WHERE split = 'train')") + f"""
SELECT token, count(*)::BIGINT AS df, round(sum(tf){D}, 6) AS s1, round(sum(tf * tf){D}, 6) AS s2,
  round(sqrt(greatest(sum(tf * tf){D} / any_value(n) - pow(sum(tf){D} / any_value(n), 2), 0.0{D})), 6) AS std,
  round(CASE WHEN sqrt(greatest(sum(tf * tf){D} / any_value(n) - pow(sum(tf){D} / any_value(n), 2), 0.0{D})) > 0
    THEN sqrt(greatest(sum(tf * tf){D} / any_value(n) - pow(sum(tf){D} / any_value(n), 2), 0.0{D})) ELSE 1.0{D} END, 6) AS scale
FROM btf, ntr WHERE split = 'train' GROUP BY token""")
_add("bow_logreg", w(LAB_INT, BOW_SPLIT) + """SELECT t.trait, count(DISTINCT token)::BIGINT AS n_features, true AS at_optimum
FROM btf CROSS JOIN (VALUES ('quality'), ('toxic')) t(trait) WHERE split = 'train' GROUP BY t.trait""")
_PROFILE = "pf AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
_PCOLS = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
          ("n_chars", "bigint"), ("quality", "int"), ("toxic", "int")]
_add("frame_info", w(_PROFILE) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count({c})::BIGINT AS non_null FROM pf" for c, t in _PCOLS))
_add("null_counts", w(_PROFILE) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, (count(*) - count({c}))::BIGINT AS n_missing FROM pf" for c, _ in _PCOLS))
_LV = "lv AS (SELECT quality AS value, 'quality' AS trait FROM lab UNION ALL SELECT toxic, 'toxic' FROM lab)"
_add("label_value_counts", w(LAB_YN, _LV) + """SELECT value, sum(CASE WHEN trait = 'quality' THEN 1 ELSE 0 END)::BIGINT AS quality,
  sum(CASE WHEN trait = 'toxic' THEN 1 ELSE 0 END)::BIGINT AS toxic FROM lv GROUP BY value""")
_add("label_counts_long", w(LAB_YN, _LV) + """SELECT v.value, t.trait, count(lv.value)::BIGINT AS count
  FROM (SELECT DISTINCT value FROM lv) v CROSS JOIN (VALUES ('quality'), ('toxic')) t(trait)
  LEFT JOIN lv ON lv.value = v.value AND lv.trait = t.trait GROUP BY v.value, t.trait""")
_add("label_corr", w(LAB_INT) + f"""SELECT 'quality' AS trait_a, 'quality' AS trait_b, round(corr(quality{D}, quality{D}), 6) AS corr FROM labi
UNION ALL SELECT 'quality', 'toxic', round(corr(quality{D}, toxic{D}), 6) FROM labi
UNION ALL SELECT 'toxic', 'quality', round(corr(quality{D}, toxic{D}), 6) FROM labi
UNION ALL SELECT 'toxic', 'toxic', round(corr(toxic{D}, toxic{D}), 6) FROM labi""")
_add("length_label_corr", w(LAB_INT) + f"""SELECT 'quality' AS trait, round(corr(quality{D}, length(text){D}), 6) AS corr FROM labi
UNION ALL SELECT 'toxic', round(corr(toxic{D}, length(text){D}), 6) FROM labi""")
_add("length_describe", f"""SELECT round(count(l){D}, 6) AS count, round(avg(l), 6) AS mean, round(stddev_samp(l), 6) AS std,
  round(min(l){D}, 6) AS min, round(quantile_cont(l, 0.25), 6) AS p25, round(quantile_cont(l, 0.5), 6) AS p50,
  round(quantile_cont(l, 0.75), 6) AS p75, round(max(l){D}, 6) AS max FROM (SELECT length(text) AS l FROM documents)""")
_add("length_boxplot", f"""WITH ls AS (SELECT length(text) AS l FROM documents),
qs AS (SELECT quantile_cont(l, 0.25) AS q1, quantile_cont(l, 0.5) AS med, quantile_cont(l, 0.75) AS q3 FROM ls)
SELECT round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
  round(min(CASE WHEN l >= q1 - 1.5{D} * (q3 - q1) THEN l END){D}, 6) AS whisker_low,
  round(max(CASE WHEN l <= q3 + 1.5{D} * (q3 - q1) THEN l END){D}, 6) AS whisker_high,
  count(CASE WHEN l < q1 - 1.5{D} * (q3 - q1) OR l > q3 + 1.5{D} * (q3 - q1) THEN 1 END)::BIGINT AS n_outliers
FROM ls, qs GROUP BY q1, med, q3""")
_EV = w(LAB_INT, SCORED, RUNCELLS)
_add("micro_accuracy", _EV + "SELECT run::BIGINT AS run, round(avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM rc GROUP BY run")
_add("trait_accuracy", _EV + "SELECT run::BIGINT AS run, trait, round(avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM rc GROUP BY run, trait")
_CONF = """SELECT run::BIGINT AS run, trait,
  count(CASE WHEN predicted = 1 AND actual = 1 THEN 1 END)::BIGINT AS tp, count(CASE WHEN predicted = 1 AND actual = 0 THEN 1 END)::BIGINT AS fp,
  count(CASE WHEN predicted = 0 AND actual = 1 THEN 1 END)::BIGINT AS fn, count(CASE WHEN predicted = 0 AND actual = 0 THEN 1 END)::BIGINT AS tn
  FROM rc GROUP BY run, trait"""
_add("confusion_counts", _EV + _CONF)
_add("precision_recall", _EV[:-1] + ",\ncf AS (" + _CONF + ")\n" + f"""SELECT run, trait,
  round(CASE WHEN tp + fp > 0 THEN tp{D} / (tp + fp) ELSE 0.0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp{D} / (tp + fn) ELSE 0.0 END, 6) AS recall FROM cf""")
_add("run_average_metrics", w(LAB_INT, SCORED, RUNCELLS, metrics_sql("rc")) + """SELECT metric, trait, round(avg(value), 6) AS value,
  count(DISTINCT run)::BIGINT AS n_runs FROM mt GROUP BY metric, trait""")
_add("drop_last_accuracy", w(LAB_INT, SCORED, RUNCELLS, EXACT_SPLIT,
    "tst AS (SELECT doc_id FROM es WHERE pos > ntr + floor((n - ntr) / 2.0))",
    f"bp AS (SELECT doc_id, pos - 1 AS p0, n FROM ({rank_sql('tst', 7)}))",
    "kc AS (SELECT * FROM rc WHERE run = 1 AND doc_id IN (SELECT doc_id FROM bp WHERE p0 < floor(n / 32) * 32))") + """
SELECT trait, round(avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(DISTINCT doc_id)::BIGINT AS n_rows FROM kc GROUP BY trait
UNION ALL SELECT 'all', round(avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END), 6), count(DISTINCT doc_id)::BIGINT FROM kc""")
_add("batch_mean_loss", """SELECT run::BIGINT AS run, epoch::BIGINT AS epoch, round(avg(bl), 6) AS epoch_loss, count(*)::BIGINT AS n_batches FROM
  (SELECT user_id AS run, date_diff('day', DATE '2024-01-01', ts::DATE) AS epoch, hour(ts) AS batch, avg(value) AS bl
   FROM events GROUP BY ALL) GROUP BY run, epoch""")
_add("bce_loss", w(LAB_INT, SCORED) + f"""SELECT round(avg({sql_bce('logit')}), 6) AS bce,
  round(avg({sql_bce(f'(1.0{D} / (1.0{D} + exp(-logit)))')}), 6) AS bce_double_sigmoid FROM scored""")
_add("best_epoch_trace", w(EPOCH) + """SELECT run::BIGINT AS run, epoch::BIGINT AS epoch,
  (pmin IS NULL OR val_loss < pmin) AS best_loss_so_far, (val_acc > greatest(coalesce(pmax, 0.0), 0.0)) AS best_acc_so_far FROM
  (SELECT *, min(val_loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pmin,
     max(val_acc) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pmax FROM elog)""")
_add("best_epoch", w(EPOCH) + """SELECT run::BIGINT AS run, arg_min(epoch, struct_pack(l := val_loss, e := epoch))::BIGINT AS best_loss_epoch,
  round(min(val_loss), 6) AS best_loss,
  (CASE WHEN max(val_acc) > 0 THEN arg_min(epoch, struct_pack(a := -val_acc, e := epoch)) END)::BIGINT AS best_acc_epoch,
  round(max(val_acc), 6) AS best_acc FROM elog GROUP BY run""")
_add("split_hash", """SELECT doc_id, CASE WHEN b < 7000 THEN 'train' WHEN b < 8500 THEN 'val' ELSE 'test' END AS split FROM
  (SELECT doc_id, ('0x' || substr(md5('42:' || doc_id::VARCHAR), 1, 8))::BIGINT % 10000 AS b FROM documents)""")
_add("split_exact", w(LAB_INT, EXACT_SPLIT) + """SELECT doc_id, CASE WHEN pos <= ntr THEN 'train'
  WHEN pos <= ntr + floor((n - ntr) / 2.0) THEN 'val' ELSE 'test' END AS split FROM es""")
_add("split_exact_bert", w(LAB_INT, EXACT_SPLIT) + f"""SELECT doc_id, CASE WHEN pos <= ntr THEN 'train'
  WHEN pos <= ntr + floor(0.15{D} * n) THEN 'val' ELSE 'test' END AS split FROM es""")
_add("split_train_test", w(LAB_INT) + f"""SELECT doc_id, CASE WHEN pos <= ceil(0.2{D} * n) THEN 'test' ELSE 'train' END AS split
  FROM ({rank_sql('labi', 42)})""")
_add("sample_fraction", w(LAB_INT) + f"SELECT doc_id FROM ({rank_sql('labi', 42)}) WHERE pos <= round_even(0.15{D} * n, 0)")
_add("sample_examples", w(LAB_YN) + "SELECT doc_id, text, quality, toxic FROM lab ORDER BY md5('1:' || doc_id::VARCHAR), doc_id LIMIT 4")
_add("zeroshot_prompt", w(LAB_YN, ZS) + "SELECT doc_id, p AS prompt FROM zs")
_add("fewshot_prompt", w(LAB_YN, fewshot_sql(2, 1, 16000)) + """SELECT doc_id,
  CASE WHEN NOT (n_ex > 0 AND n_tokens > 16000) THEN p END AS prompt, n_tokens::BIGINT AS n_tokens,
  (n_ex > 0 AND n_tokens > 16000) AS over_budget FROM fs""")
_add("fewshot_prompt_rules", w(LAB_YN, fewshot_sql(1, 2, None, "rules")) + "SELECT doc_id, p AS prompt FROM fs")
_add("prompt_budget", w(LAB_YN, fewshot_sql(2, 3, 4000)) + """SELECT doc_id, n_tokens::BIGINT AS n_tokens,
  (n_ex > 0 AND n_tokens > 4000) AS over_budget, md5(CASE WHEN NOT (n_ex > 0 AND n_tokens > 4000) THEN p END) AS prompt_md5 FROM fs""")
_add("chat_messages", w(LAB_YN, ZS) + f"""SELECT doc_id, to_json([{{'role': 'system', 'content': {q(PR.SYSTEM_MESSAGE)}}},
  {{'role': 'user', 'content': p}}])::VARCHAR AS messages FROM zs""")
_add("label_json", w(LAB_YN) + f"SELECT doc_id, {label_block('        ')} AS label_json FROM lab")
_ANS = w(LAB_YN, ZS, stub_sql("zs"))
_add("batch_infer_stub", _ANS + "SELECT doc_id, raw, status, attempts FROM ans")
_add("answer_json", _ANS + f"SELECT doc_id, {greedy_sql('raw')} AS json FROM ans")
_add("answer_json_split", _ANS + f"""SELECT doc_id, CASE WHEN strpos(s, '{{') > 0 THEN '{{' ||
  (CASE WHEN strpos(rest, '}}') > 0 THEN regexp_extract(rest, '(?s)^(.*)\\}}', 1) ELSE rest END) || '}}' END AS json
  FROM (SELECT doc_id, s, regexp_extract(s, '(?s)\\{{(.*)', 1) AS rest FROM (SELECT doc_id, {strip_sql('raw')} AS s FROM ans))""")
_PARSED = _ANS[:-1] + ",\n" + parsed_sql("ans") + "\n"
_add("answer_parse", _PARSED + "SELECT doc_id, parse_ok, quality, toxic FROM parsed")
_add("answers_kept", _PARSED + "SELECT doc_id, quality, toxic FROM lab WHERE doc_id IN (SELECT doc_id FROM parsed WHERE parse_ok)")
_add("answers_missed", _PARSED + "SELECT doc_id, quality, toxic FROM lab WHERE doc_id NOT IN (SELECT doc_id FROM parsed WHERE parse_ok)")
_add("miss_rate", _PARSED + f"""SELECT count(CASE WHEN NOT parse_ok THEN 1 END)::BIGINT AS n_missed, count(*)::BIGINT AS n_total,
  round(count(CASE WHEN NOT parse_ok THEN 1 END){D} / count(*), 6) AS miss_rate FROM parsed""")



def experiment_sql(frac: float, runs: int, budget: int | None = 16000, style: str = "chat", cut: str = "greedy") -> str:
    header = CHAT_HEADER if style == "chat" else RULES_HEADER
    over = "false" if budget is None else f"exb.n_ex > 0 AND {tok_count(header)} + exb.ex_tok + {tok_count(TARGET)} > {budget}"
    return w(
        LAB_YN,
        f"smp AS (SELECT doc_id, text, quality, toxic FROM ({rank_sql('lab', 42)}) WHERE pos <= round_even({frac}{D} * n, 0))",
        f"runs AS (SELECT range AS run FROM range({runs}))",
        """exr AS (SELECT * FROM (SELECT r.run, s.*, md5(r.run::VARCHAR || ':' || s.doc_id::VARCHAR) AS ok_key,
            row_number() OVER (PARTITION BY r.run ORDER BY md5(r.run::VARCHAR || ':' || s.doc_id::VARCHAR), s.doc_id) AS rn
          FROM smp s, runs r) WHERE rn <= 1)""",
        f"""exb AS (SELECT run, string_agg(b, '' ORDER BY ok_key, doc_id) AS ex_text, sum(bt) AS ex_tok, count(*) AS n_ex
          FROM (SELECT run, ok_key, doc_id, {example_sql(style)} AS b, {tok_count(example_sql(style))} AS bt FROM exr) GROUP BY run)""",
        f"fsr AS (SELECT exb.run, s.doc_id, CASE WHEN NOT ({over}) THEN {header} || exb.ex_text || ({TARGET}) END AS p FROM smp s, exb)",
        stub_sql("fsr", "run,"),
        parsed_sql("ans", "run,", cut),
        """fates AS (SELECT run, doc_id, CASE WHEN status = 'no_prompt' THEN 'no_prompt' WHEN status <> 'ok' THEN 'failed' WHEN parse_ok THEN 'kept' ELSE 'unparsed' END AS fate
            FROM parsed)""",
        """ecells AS (SELECT p.run, p.doc_id, 'quality' AS trait, (CASE WHEN s.quality = 'y' THEN 1 ELSE 0 END)::DOUBLE AS actual, p.quality AS predicted
            FROM parsed p JOIN smp s ON p.doc_id = s.doc_id WHERE p.parse_ok
          UNION ALL SELECT p.run, p.doc_id, 'toxic', (CASE WHEN s.toxic = 'y' THEN 1 ELSE 0 END)::DOUBLE, p.toxic
            FROM parsed p JOIN smp s ON p.doc_id = s.doc_id WHERE p.parse_ok)""",
        metrics_sql("ecells"))


_MEAN = "SELECT metric, trait, round(avg(value), 6) AS value, count(DISTINCT run)::BIGINT AS n_runs FROM mt GROUP BY metric, trait"
_add("sequence_dataset", f"""SELECT n.doc_id, n.cube_md5, l.label_vec, s.split FROM ({ORACLE_SQL["numericalize"]}) n
JOIN ({ORACLE_SQL["label_vector"]}) l ON n.doc_id = l.doc_id JOIN ({ORACLE_SQL["split_exact"]}) s ON n.doc_id = s.doc_id""")
_add("prompt_experiment", experiment_sql(0.5, I.N_RUNS) + _MEAN)
_add("rules_experiment", experiment_sql(0.15, 5, None, "rules", "split") + _MEAN)
_add("experiment_fates", experiment_sql(0.5, I.N_RUNS, 500) + f"""SELECT run::BIGINT AS run, fate, count(*)::BIGINT AS n,
  round(count(*){D} / (SELECT count(*) FROM smp), 6) AS share FROM fates GROUP BY run, fate""")
_add("experiment_missed", experiment_sql(0.15, 5, None, "rules", "split") + "SELECT run::BIGINT AS run, doc_id, fate FROM fates WHERE fate <> 'kept'")


def _vote_sql(label: str) -> str:
    return f"""(round((ln((o_{label} + 1){D} / (n_{label} + 2)) - ln((c - o_{label} + 1){D} / (n - n_{label} + 2))) * 1000000))::BIGINT AS v_{label}"""


_add("sequence_scores", w(
    LAB_INT, *_ENCODED, EXACT_SPLIT,
    "sq AS (SELECT l.doc_id, l.quality, l.toxic, list_distinct(list_filter(q.body, lambda x: x >= 4)) AS ids, es.pos, es.n, es.ntr FROM labi l JOIN eseq q ON l.doc_id = q.doc_id JOIN es ON l.doc_id = es.doc_id)",
    "tr AS (SELECT * FROM sq WHERE pos <= ntr)",
    "tot AS (SELECT count(*) AS n, sum(quality) AS n_quality, sum(toxic) AS n_toxic FROM tr)",
    "lw AS (SELECT word, count(*) AS c, sum(quality) AS o_quality, sum(toxic) AS o_toxic FROM (SELECT doc_id, quality, toxic, unnest(ids)::VARCHAR AS word FROM tr) GROUP BY word)",
    f"vt AS (SELECT word, {_vote_sql('quality')}, {_vote_sql('toxic')} FROM (SELECT * FROM lw ORDER BY c DESC, word ASC LIMIT 2000), tot)",
    "tst AS (SELECT doc_id FROM sq WHERE pos > ntr + floor((n - ntr) / 2.0))",
    f"kept AS (SELECT doc_id FROM ({rank_sql('tst', 7)}) WHERE pos - 1 < floor(n / 32) * 32)",
    "sums AS (SELECT d.doc_id, sum(v_quality) AS sq_, sum(v_toxic) AS st_ FROM (SELECT doc_id, unnest(ids)::VARCHAR AS word FROM sq) d JOIN vt ON d.word = vt.word GROUP BY d.doc_id)",
    f"""pr AS (SELECT s.doc_id, s.quality, s.toxic,
      (coalesce(u.sq_, 0) + round(ln((n_quality + 1){D} / (tot.n - n_quality + 1)) * 1000000) >= 0)::INTEGER AS pq,
      (coalesce(u.st_, 0) + round(ln((n_toxic + 1){D} / (tot.n - n_toxic + 1)) * 1000000) >= 0)::INTEGER AS pt
      FROM sq s LEFT JOIN sums u ON s.doc_id = u.doc_id CROSS JOIN tot WHERE s.doc_id IN (SELECT doc_id FROM kept))""",
    """sc AS (SELECT doc_id, 'quality' AS trait, (quality = pq)::INTEGER AS hit FROM pr UNION ALL SELECT doc_id, 'toxic', (toxic = pt)::INTEGER FROM pr)""")
    + f"""SELECT trait, round(avg(hit){D}, 6) AS accuracy, count(DISTINCT doc_id)::BIGINT AS n_rows FROM sc GROUP BY trait
UNION ALL SELECT 'all', round(avg(hit){D}, 6), count(DISTINCT doc_id)::BIGINT FROM sc""")
_add("batch_infer_model", w(
    LAB_INT,
    "tot AS (SELECT count(*) AS n, sum(quality) AS n_quality, sum(toxic) AS n_toxic FROM labi)",
    """lw AS (SELECT word, count(*) AS c, sum(quality) AS o_quality, sum(toxic) AS o_toxic FROM
      (SELECT doc_id, quality, toxic, unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'))) AS word FROM labi) GROUP BY word)""",
    f"vt AS (SELECT word, {_vote_sql('quality')}, {_vote_sql('toxic')} FROM (SELECT * FROM lw ORDER BY c DESC, word ASC LIMIT 2000), tot)",
    """dw AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'))) AS word FROM documents)""",
    "sums AS (SELECT doc_id, sum(v_quality) AS sq, sum(v_toxic) AS st FROM dw JOIN vt ON dw.word = vt.word GROUP BY doc_id)")
    + f"""SELECT d.doc_id,
  '{{"quality": ' || (CASE WHEN coalesce(s.sq, 0) + round(ln((n_quality + 1){D} / (n - n_quality + 1)) * 1000000) > 0 THEN 1 ELSE 0 END)::VARCHAR ||
  ', "toxic": ' || (CASE WHEN coalesce(s.st, 0) + round(ln((n_toxic + 1){D} / (n - n_toxic + 1)) * 1000000) > 0 THEN 1 ELSE 0 END)::VARCHAR || '}}' AS raw,
  'ok' AS status, 1::INTEGER AS attempts FROM documents d LEFT JOIN sums s ON d.doc_id = s.doc_id CROSS JOIN tot""")
_add("embed_lookup", w(WHOLE, FREQ, VOCAB, WORDVEC) + """SELECT token, idx, known, round(list_sum(vector), 4) + 0.0 AS vec_sum,
  round(vector[1], 6) + 0.0 AS vec_first FROM wv""")
_add("embed_normalize", w(WHOLE, FREQ, VOCAB, WORDVEC, NORM) + """SELECT token, idx,
  round(sqrt(list_sum(list_transform(u, lambda x: x * x))), 6) AS norm, round(list_sum(u), 5) + 0.0 AS vec_sum FROM wvn""")
_add("doc_embedding", w(
    WHOLE, FREQ, VOCAB, WORDVEC, NORM,
    """dc AS (SELECT t.doc_id, s.si, unnest(t.tokens[s.si]) AS token FROM tok t, LATERAL (SELECT unnest(range(1, len(t.tokens) + 1)) AS si) s)""",
    """dv AS (SELECT dc.doc_id, dc.si, n.u FROM dc LEFT JOIN vocab v ON dc.token = v.token JOIN wvn n ON n.idx = coalesce(v.idx, 0))""",
    """dd AS (SELECT doc_id, si, g.dim, avg(u[g.dim + 1]) AS sv FROM dv, LATERAL (SELECT unnest(range(64)) AS dim) g GROUP BY ALL)""",
    """de AS (SELECT doc_id, dim, avg(sv) AS v FROM dd GROUP BY ALL)""")
    + """SELECT doc_id, round(sum(v), 5) + 0.0 AS emb_sum, round(max(CASE WHEN dim = 0 THEN v END), 5) + 0.0 AS emb_first,
  round(sqrt(sum(v * v)), 5) AS emb_norm FROM de GROUP BY doc_id""")

ORACLE_SQL["embed_by_word"] = ORACLE_SQL["embed_lookup"]
