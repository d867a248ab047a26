"""Row expansion (D1-D8) and bag union.

Template and phrase tables are folded into array expressions, so each
expansion is a projection + ``posexplode``: no join, no shuffle, codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom import defaults as D
from textloom.functions.text import (contains_ci, in_ci, or_empty_array, squeeze, strip_tags,
                                     strip_trailing, template)


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _empty() -> Column:
    return F.array().cast("array<string>")


def description_slot(text: Column | str, clean: bool = True) -> Column:
    """The text put into templates: (squeeze, strip tags,) lower, strip trailing dots."""
    d = strip_tags(squeeze(text)) if clean else _c(text)
    return strip_trailing(F.lower(d), ".")


def augment(df: DataFrame, key: str, text: str, templates: Sequence[str],
            phrases: Sequence[tuple[Sequence[str], Sequence[str]]] | None = None,
            carry: Sequence[str] = (), out: str = "query", pos: str = "pos",
            clean: bool = True) -> DataFrame:
    """One row per template, then the phrases of every alias group
    whose aliases contain ``lower(key)`` (groups in order, like successive ifs).

    Output: ``key, pos, out, description`` (+ ``carry``), where
    ``description`` is the squeezed, tag-stripped text (D1 keeps it).
    """
    desc = strip_tags(squeeze(text)) if clean else F.col(text)
    slot = strip_trailing(F.lower(desc), ".")
    arr = F.array(*[template(t, slot) for t in templates])
    for aliases, plist in phrases or ():
        arr = F.concat(arr, F.when(in_ci(key, aliases), F.array(*[F.lit(p) for p in plist]))
                       .otherwise(_empty()))
    return df.select(key, *carry, desc.alias("description"),
                     F.posexplode(arr).alias(pos, out))


@dataclass
class Rule:
    """D5 rule: ``query`` template; emitted when ``when`` holds (always if None);
    ``command`` replaces the key column when given."""
    query: str
    when: Column | None = None
    command: str | None = None


def pair_rules(df: DataFrame, key: str, text: str, rules: Sequence[Rule],
               out: str = "query", command: str = "command", pos: str = "pos",
               carry: Sequence[str] = (), command_col: str | None = None) -> DataFrame:
    """Conditional pair generation. The slot is ``lower(text)`` with
    trailing dots stripped (no squeeze, no tag stripping). ``pos`` numbers
    the emitted pairs of a row in rule order. The pair's command is
    ``command_col`` (default: the key) unless the rule names one."""
    slot = strip_trailing(F.lower(F.col(text)), ".")
    src = F.col(command_col or key)
    cands = []
    for r in rules:
        s = F.struct(template(r.query, slot).alias("q"),
                     (F.lit(r.command) if r.command is not None else src).alias("c"))
        cands.append(F.when(r.when, s) if r.when is not None else s)
    kept = F.filter(F.array(*cands), lambda x: x.isNotNull())
    return (df.select(key, *carry, F.posexplode(kept).alias(pos, "_p"))
            .select(*([key] if key != command else []), *carry, pos,
                    F.col("_p.q").alias(out), F.col("_p.c").alias(command)))


def default_pair_rules(key: str = "command", text: str = "description") -> list[Rule]:
    """The catalogue rules (fixed values in ``defaults.PAIR_RULES``)."""
    rules = []
    for q, needle, cmd, key_eq in D.PAIR_RULES:
        cond = None
        if needle is not None:
            cond = contains_ci(text, needle)
        if key_eq is not None:
            cond = F.lower(F.col(key)) == key_eq.lower()
        rules.append(Rule(q, cond, cmd))
    return rules


def prompt_fanout(df: DataFrame, text: str, prefixes: Sequence[str] = tuple(D.PROMPT_PREFIXES),
                  out: str = "input_text", variant: str = "variant",
                  keep: Sequence[str] | None = None) -> DataFrame:
    """One row per prefix: ``prefix || text``."""
    keep = [c for c in df.columns if c != text] if keep is None else list(keep)
    arr = F.array(*[F.concat(F.lit(p), F.col(text)) for p in prefixes])
    return df.select(*keep, F.posexplode(arr).alias(variant, out))


def lm_records(df: DataFrame, query: str, command: str, explanation: str,
               out: str = "text") -> DataFrame:
    """``Query: q\\nCommand: c\\nExplanation: e\\n\\n`` (NULL stays visible)."""
    a, b, c, d = D.LM_RECORD
    rec = F.concat(F.lit(a), F.col(query), F.lit(b), F.col(command), F.lit(c),
                   F.col(explanation), F.lit(d))
    return df.withColumn(out, rec)


def retrieval_text(df: DataFrame, key: str, text: str, examples: str,
                   out: str = "text") -> DataFrame:
    """``key: text. Examples: e1 e2 ...`` (null examples -> none)."""
    a, b = D.RETRIEVAL_TEXT
    rec = F.concat(F.col(key), F.lit(a), F.col(text), F.lit(b),
                   F.array_join(or_empty_array(examples), " "))
    return df.withColumn(out, rec)


def union_rows(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name (duplicates kept)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
