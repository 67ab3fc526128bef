"""Records rendered as text [P7-P9]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import per_mtok, per_unit

# labels, pricing keys and units of a model record (fixed values)
TOKEN_PRICES = (("prompt", "prompt"), ("completion", "completion"), ("cache read (input)", "input_cache_read"), ("cache write (input)", "input_cache_write"), ("internal reasoning", "internal_reasoning"))
UNIT_PRICES = (("image", "image", "image"), ("audio", "audio", "audio-min"), ("per request", "request", "request"), ("web search", "web_search", "search"))
SENTINELS = ("<no-text>", "<refused>")


def filled(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def labelled(fields: list[tuple[str, Column, Column | None]]) -> Column:
    """[P7] A line ``label: value`` for each filled value, notes after it in brackets."""
    lines = []
    for label, value, notes in fields:
        line = F.concat(F.lit(f"{label}: "), filled(value))
        lines.append(line if notes is None else F.when(filled(notes).isNull(), line).otherwise(F.concat(line, F.lit("  ("), filled(notes), F.lit(")"))))
    return F.concat_ws("\n", *lines)


def caption(title: Column, joke: Column, ocr: Column, topics: Column) -> Column:
    """[P6, P8] Filled parts with an empty line between; sentinel texts count as none."""
    return F.concat_ws(
        "\n\n",
        F.concat(F.lit("Caption: "), F.nullif(title, F.lit(""))),
        F.concat(F.lit("Joke: "), F.nullif(joke, F.lit(""))),
        F.when(~ocr.isin(*SENTINELS), F.concat(F.lit("Text on image:\n"), F.nullif(ocr, F.lit("")))),
        F.when(F.size(topics) > 0, F.concat(F.lit("Topics: "), F.array_join(topics, ", "))),
    )


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def model_record(m: str = "m") -> Column:
    """[P9] A model of a JSON catalog: names, context, modalities, prices, parameters, description."""
    c = lambda path: F.col(f"{m}.{path}")
    line = lambda label, value: F.concat(F.lit(f"{label}: "), value)
    none_if_zero = lambda x: F.when(x != 0, x)
    context = F.coalesce(none_if_zero(c("top_provider.context_length")), none_if_zero(c("context_length")))
    ins, outs = (F.coalesce(c(f"architecture.{k}_modalities"), F.array().cast("array<string>")) for k in ("input", "output"))
    prices = [F.concat(F.lit(f"  {label}: "), per_mtok(c("pricing")[key])) for label, key in TOKEN_PRICES]
    prices += [F.concat(F.lit(f"  {label}: "), per_unit(c("pricing")[key], unit)) for label, key, unit in UNIT_PRICES]
    priced = F.concat_ws("\n", *prices)
    head = F.concat_ws(
        "\n",
        F.coalesce(F.nullif(c("name"), F.lit("")), F.nullif(c("id"), F.lit("")), F.lit("(unknown)")),
        line("OpenRouter id", c("id")),
        F.when(c("canonical_slug") != c("id"), line("Canonical slug", F.nullif(c("canonical_slug"), F.lit("")))),
        line("Hugging Face", F.nullif(c("hugging_face_id"), F.lit(""))),
        F.concat(F.lit("Context window: "), thousands(context), F.lit(" tokens")),
        line("Max completion tokens", thousands(none_if_zero(c("top_provider.max_completion_tokens")))),
        line("Modality", F.nullif(c("architecture.modality"), F.lit(""))),
        F.when(F.size(ins) + F.size(outs) > 0, F.concat(F.lit("Modalities: input=["), F.array_join(ins, ", "), F.lit("], output=["), F.array_join(outs, ", "), F.lit("]"))),
        line("Tokenizer", F.nullif(c("architecture.tokenizer"), F.lit(""))),
        line("Instruct format", F.nullif(c("architecture.instruct_type"), F.lit(""))),
        line("Knowledge cutoff", F.nullif(c("knowledge_cutoff"), F.lit(""))),
        F.when(priced != "", F.concat(F.lit("Pricing (USD):\n"), priced)),
        F.when(c("top_provider.is_moderated"), F.lit("Provider moderation: enabled")),
        F.when(F.size(c("supported_parameters")) > 0, line("Supported parameters", F.array_join(F.array_sort(c("supported_parameters")), ", "))),
    )
    text = filled(c("description"))
    return F.trim(F.when(text.isNull(), head).otherwise(F.concat(head, F.lit("\n\n"), text)))
