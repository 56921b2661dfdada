"""Prompt tables (STR14-STR18, JN3, JSN4).

Every prompt is a ``concat`` of literals and columns. Few-shot examples are a k-row sample
folded into ONE row (bounded by k) and attached to every target by a broadcast cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonparse import label_json
from ..functions.labels import encode_lenient

# ---------------------------------------------------------------------------
# Prompt wording and layout (must equal the reference's text).
REFERENCE_TRAITS = [("Extraversion", "cEXT"), ("Neuroticism", "cNEU"), ("Agreeableness", "cAGR"),
                    ("Conscientiousness", "cCON"), ("Openness", "cOPN")]
INTRO = "Analyze the following text and determine if the author exhibits the following traits: "
CHAT_RULE = "Indicate 1 if the trait is exhibited, 0 if not. Use {keys} to represent each trait."
CHAT_FORMAT = "Return only results in JSON format without indicating it is JSON file. "
RULES_FORMAT = ("Please provide results in JSON format without further explanation and "
                "without indicating it is a JSON file.")
RULES_HEAD = "The rules are as follows:"
RULE_LINE = '"{key}": 0,  # 1 if {name} is exhibited, 0 if not'
RULE_LAST = '"{key}": 0   # 1 if {name} is exhibited, 0 if not'
TARGET_HEAD = "Analyze the essay:"
CHAT_EXAMPLE_HEAD = "Example:"
RULES_EXAMPLE_HEAD = "Here is an example:\n{pad}Analyze the essay"
SYSTEM_MESSAGE = "Analyze essays and indicate personality traits."
# ---------------------------------------------------------------------------

DEFAULT_BUDGET = 16000


def _trait_list(traits) -> str:
    return ", ".join(f"{name} ({key})" for name, key in traits)


def _key_list(traits) -> str:
    keys = [k for _, k in traits]
    return keys[0] if len(keys) == 1 else ", ".join(keys[:-1]) + " and " + keys[-1]


def chat_header(traits=REFERENCE_TRAITS) -> str:
    i = "\n    "
    return (i + INTRO + _trait_list(traits) + "." + i + CHAT_RULE.format(keys=_key_list(traits))
            + i + CHAT_FORMAT + i)


def rules_header(traits=REFERENCE_TRAITS) -> str:
    lines = [RULE_LINE.format(key=k, name=n) for n, k in traits[:-1]]
    lines.append(RULE_LAST.format(key=traits[-1][1], name=traits[-1][0]))
    return ("\n    " + INTRO + _trait_list(traits) + ". " + RULES_FORMAT + "\n\n    " + RULES_HEAD + "\n"
            + "".join("        " + ln + "\n" for ln in lines) + "    ")


def target_block(text) -> Column:
    return F.concat(F.lit("\n    " + TARGET_HEAD + "\n    "), text, F.lit("\n    "))


def example_block(text: Column, labels: list[Column], keys: list[str], style: str = "chat") -> Column:
    """One example: quoted text then the label JSON block (JSN4)."""
    pad = "        " if style == "chat" else "            "
    head = CHAT_EXAMPLE_HEAD if style == "chat" else RULES_EXAMPLE_HEAD.format(pad=pad)
    return F.concat(F.lit("\n" + pad + head + "\n" + pad + '"'), text, F.lit('"\n\n'),
                    label_json(labels, keys, indent=pad), F.lit("\n" + pad))


def approx_tokens(c) -> Column:
    """Native token estimate: words and single punctuation marks. Additive over the
    whitespace-separated prompt parts, so part counts can be summed."""
    return F.size(F.regexp_extract_all(c, F.lit(r"\w+|[^\w\s]"), 0))


def examples_row(examples: DataFrame, label_cols: list[str], text: str = "text",
                 key: str = "doc_id", seed: int = 0, style: str = "chat",
                 by: list[str] | None = None) -> DataFrame:
    """Fold the (k-row) example sample into one row per ``by`` group (e.g. per run): blocks
    in seeded order and their token total. The result has as many rows as groups."""
    from ..operators.ranking import md5_key
    by = by or []
    labels = [encode_lenient(c) for c in label_cols]
    order = F.col("_order") if "_order" in examples.columns else md5_key(seed, key)
    blocks = examples.select(
        *by, order.alias("_k"), F.col(key),
        example_block(F.col(text), labels, label_cols, style).alias("block"))
    folded = blocks.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_k", key, "block"))).alias("_ex"))
    return folded.select(
        *by, "_ex",
        F.array_join(F.transform("_ex", lambda e: e["block"]), "").alias("examples_text"),
        F.coalesce(F.aggregate(F.transform("_ex", lambda e: approx_tokens(e["block"])),
                               F.lit(0), lambda a, b: a + b), F.lit(0)).alias("examples_tokens"),
        F.size("_ex").alias("n_examples"))


def zero_shot_prompts(df: DataFrame, traits, text: str = "text", key: str = "doc_id") -> DataFrame:
    """STR14: header + target."""
    return df.select(key, F.concat(F.lit(chat_header(traits)), target_block(F.col(text))).alias("prompt"))


def few_shot_prompts(df: DataFrame, examples: DataFrame, traits, label_cols: list[str],
                     text: str = "text", key: str = "doc_id", seed: int = 0,
                     budget: int | None = DEFAULT_BUDGET, style: str = "chat",
                     by: list[str] | None = None, exclude_self: bool = False,
                     token_counter=None) -> DataFrame:
    """STR15/STR16 + JN3 + STR18: the same examples before every target.

    ``by``: the examples carry a group column (e.g. ``run``); every target gets one prompt
    per group. With a ``budget`` (chat style) a prompt whose token estimate exceeds it is
    null and flagged ``over_budget`` (the reference would loop forever here, quirk Q6).
    """
    by = by or []
    header = chat_header(traits) if style == "chat" else rules_header(traits)
    # one row per group (k examples each): a proven-small broadcast side
    ex = F.broadcast(examples_row(examples, label_cols, text, key, seed, style, by))
    target = target_block(F.col(text))
    joined = df.select(key, text).crossJoin(ex)
    if exclude_self:
        # a target never sees itself as an example (option for quirk Q15)
        own = F.filter("_ex", lambda e: e[key] != F.col(key))
        joined = (joined
                  .withColumn("examples_text", F.array_join(F.transform(own, lambda e: e["block"]), ""))
                  .withColumn("examples_tokens", F.coalesce(F.aggregate(
                      F.transform(own, lambda e: approx_tokens(e["block"])), F.lit(0), lambda a, b: a + b), F.lit(0)))
                  .withColumn("n_examples", F.size(own)))
    prompt = F.concat(F.lit(header), F.col("examples_text"), target)
    if token_counter is None:
        # additive native estimate: header + examples (counted once, in the one-row fold) + target
        n_tokens = F.lit(0) + approx_tokens(F.lit(header)) + F.col("examples_tokens") + approx_tokens(target)
    else:
        # any Column -> Column counter (e.g. a pandas UDF around a BPE encoder), applied to the
        # full prompt: the prefix with every example is the largest one checked
        n_tokens = token_counter(prompt)
    out = joined.select(*by, key, prompt.alias("_prompt"), n_tokens.alias("n_tokens"), "n_examples")
    if budget is None or style != "chat":
        return out.select(*by, key, F.col("_prompt").alias("prompt"), "n_tokens")
    # the reference only counts when an example is added; zero examples never overflow
    over = (F.col("n_examples") > 0) & (F.col("n_tokens") > budget)
    return out.select(*by, key, F.when(~over, F.col("_prompt")).alias("prompt"), "n_tokens",
                      over.alias("over_budget"))


def chat_messages(prompts: DataFrame, key: str = "doc_id", prompt: str = "prompt") -> DataFrame:
    """STR17: [system, user] message list as JSON text."""
    msgs = F.array(F.struct(F.lit("system").alias("role"), F.lit(SYSTEM_MESSAGE).alias("content")),
                   F.struct(F.lit("user").alias("role"), F.col(prompt).alias("content")))
    return prompts.select(key, F.to_json(msgs).alias("messages"))
