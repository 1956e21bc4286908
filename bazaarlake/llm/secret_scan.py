"""Secret scans behind a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived: an OR of ANDs of trigrams, one of which any
text with a match must satisfy. The inverted index lists, for every trigram that some query names, the documents
whose lower-cased text has it. Intersecting the postings gives (document, rule) candidates, and only these are searched by
the expression. A rule without mandatory trigrams searches all texts. Only built-in functions are used.

A rule's matches are leftmost and do not overlap; those whose tested group is too short are dropped. Places are code
points from 0, the end exclusive.

Defined results: null or empty text has no spans; rows with one id and one text are one document and give one row each;
a null id is an id of its own; overlapping spans of different rules all stay; other columns are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # the group whose length counts
    least: int = 1  # its least length
    any_case: bool = False


# Kinds and expressions.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)

# Forms of well-known credentials.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", 0, 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 0, 30),
    Rule("key-block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("bearer", r"bearer\x20+([A-Za-z0-9+/_.=-]+)", 1, 20, True),
    Rule("url-login", r"[a-z]+://[^\s:/@]+:([^\s/@]+)@", 1, 4),
)

RULES = BASE + MORE
#: Strings that a part of an expression may stand for, at most; a part with more counts as unknown.
MOST_STRINGS = 64

Parser = re._parser  # the parsed form of an expression, as the standard library has it


def strings_of(node: tuple) -> set[str] | None:
    """All strings that a part matches, or None if they are many or unknown."""
    op, value = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(value)}
    if op == "IN":
        chars: set[str] = set()
        for kind, x in value:
            if str(kind) == "LITERAL":
                chars.add(chr(x))
            elif str(kind) == "RANGE" and x[1] - x[0] < MOST_STRINGS:
                chars |= {chr(c) for c in range(x[0], x[1] + 1)}
            else:
                return None
        return chars if len(chars) <= MOST_STRINGS else None
    if op == "BRANCH":
        parts = [joined(list(branch)) for branch in value[1]]
        return None if None in parts else set().union(*parts)
    if op == "SUBPATTERN":
        return joined(list(value[3]))
    if op == "MAX_REPEAT" and value[1] != Parser.MAXREPEAT and value[1] <= 4:
        one = joined(list(value[2]))
        found = None if one is None else {"".join(p) for n in range(value[0], value[1] + 1) for p in product(one, repeat=n)}
        return found if found is not None and len(found) <= MOST_STRINGS else None
    return None


def joined(nodes: list) -> set[str] | None:
    found = {""}
    for node in nodes:
        more = strings_of(node)
        if more is None or len(found) * len(more) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in more}
    return found


def runs(nodes: list) -> list[set[str]]:
    """For each run of neighbouring parts with known strings, the strings of the run. All runs are mandatory."""
    out, now = [], {""}
    for node in nodes:
        more = strings_of(node)
        if more is not None and len(now) * len(more) <= MOST_STRINGS:
            now = {a + b for a in now for b in more}
            continue
        out.append(now)
        now = more or {""}
        if more is None and str(node[0]) == "MAX_REPEAT" and node[1][0] >= 1:
            out += runs(list(node[1][2]))
        elif more is None and str(node[0]) == "SUBPATTERN":
            out += runs(list(node[1][3]))
    return [*out, now]


def trigram_query(rule: Rule) -> list[frozenset[str]]:
    """Sets of lower-cased trigrams; a text with a match has all trigrams of one set at least. Empty: nothing is mandatory.

    Of the rule's runs the one counts that asks for most trigrams in its weakest alternative.
    """
    best: list[frozenset[str]] = []
    for strings in runs(list(Parser.parse(rule.pattern))):
        sets = {frozenset(s.lower()[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if sets and all(sets) and min(map(len, sets)) > min(map(len, best), default=0):
            best = sorted((s for s in sets if not any(t < s for t in sets)), key=sorted)
    return best


SPANS = "array<struct<start:int,end:int>>"


def found(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of a rule's matches in a text."""
    pattern = F.lit(f"(?i){rule.pattern}" if rule.any_case else rule.pattern)
    if rule.group == 0 and rule.least > 1 and re.fullmatch(r"\[[^]]+\]\+", rule.pattern):
        # a run of one class: the long runs are found at once
        pattern = F.lit(f"{rule.pattern[:-1]}{{{rule.least},}}")
    sizes = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("before"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("whole"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("tested"),
    )
    # a match starts behind all pieces and matches before it; the last piece has no match
    walk = F.aggregate(
        sizes,
        F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + x["before"] + F.coalesce(x["whole"], F.lit(0))).alias("at"),
            F.when(
                x["tested"] >= rule.least,
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["before"]).alias("start"), (acc["at"] + x["before"] + x["whole"]).alias("end")
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
    )
    return walk["spans"]


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(hit_id, hit_key, rules): documents whose trigrams satisfy a rule's query, and the numbers of these rules."""
    queries = [(n, c, s) for n, rule in enumerate(rules) for c, s in enumerate(trigram_query(rule))]
    trigrams = sorted({t for _, _, s in queries for t in s})
    # lower-cased once, more than A-Z, so it finds a few candidates more
    small = docs.select("doc_id", "text_key", F.lower("text").alias("small"))
    there = F.array(*(F.when(F.contains("small", F.lit(t)), F.lit(t)) for t in trigrams))
    postings = small.select("doc_id", "text_key", F.explode(F.array_compact(there)).alias("trigram"))
    wanted = docs.sparkSession.range(1).select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(t).alias("of"), F.lit(n).alias("rule"), F.lit(c).alias("choice"), F.lit(len(s)).alias("need"))
                    for n, c, s in queries
                    for t in sorted(s)
                )
            )
        )
    )
    return (
        postings.join(F.broadcast(wanted), F.col("trigram") == F.col("of"))  # a list as long as the rules
        .groupBy("doc_id", "text_key", "rule", "choice")
        .agg(F.collect_set("trigram").alias("has"), F.first("need").alias("need"))
        .where(F.size("has") == F.col("need"))
        .groupBy(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"))
        .agg(F.collect_set("rule").alias("rules"))
    )


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text and spans, an array of (start, rule number, end), for each row. carry: further columns to keep."""
    keyed = docs.select("doc_id", "text", *carry, F.xxhash64("text").alias("text_key"))
    hit = candidates(keyed.select("doc_id", "text_key", "text"), rules)
    both = keyed.join(
        hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & F.col("text_key").eqNullSafe(F.col("hit_key")), "left"
    )
    text = F.coalesce("text", F.lit(""))
    nothing = F.array().cast(SPANS)
    spans = []
    for number, rule in enumerate(rules):
        asked = F.array_contains("rules", number) if trigram_query(rule) else quick(text, rule)
        own = F.when(F.coalesce(asked, F.lit(False)), found(text, rule)).otherwise(nothing)
        spans.append(F.transform(own, numbered(number)))
    return both.select("doc_id", "text", *carry, F.array_sort(F.concat(*spans)).alias("spans"))


def numbered(number: int) -> Callable[[Column], Column]:
    return lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("rule"), s["end"].alias("end"))


def of_rule(number: int) -> Callable[[Column], Column]:
    return lambda s: s["rule"] == number


def quick(text: Column, rule: Rule) -> Column:
    """Whether a full scan finds a match at all."""
    return F.rlike(text, F.lit(f"{rule.pattern[:-1]}{{{rule.least}}}" if rule.pattern.endswith("]+") else rule.pattern))


def named(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of all spans, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, n_base: int = len(BASE)) -> DataFrame:
    """doc_id, the number of spans of each base rule as n_<kind>, base_spans and spans as text, for each row."""
    with_spans = secret_spans(docs, rules)
    base = F.filter("spans", lambda s: s["rule"] < n_base)
    counts = [
        F.size(F.filter("spans", of_rule(n))).cast("long").alias(f"n_{rule.kind}")
        for n, rule in enumerate(rules[:n_base])
    ]
    return with_spans.select("doc_id", *counts, named(base, rules).alias("base_spans"), named(F.col("spans"), rules).alias("spans"))


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """The documents with every span, overlapping ones as one, replaced by a mark; n_chars follows if it is there."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", F.struct(*others, F.lit(1).alias("_")).alias("row"))
    with_spans = secret_spans(rows, rules, carry=("row",))
    walk = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= acc["at"],
                F.concat(acc["out"], F.substring("text", acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
    )
    clean = F.when(
        F.size("spans") > 0, F.concat(walk["out"], F.substring("text", walk["at"] + 1, F.length("text")))
    ).otherwise(F.col("text"))
    columns = [
        F.col(c) if c in ("doc_id", "text") else F.length("text").cast(kind).alias(c) if c == "n_chars" else F.col("row")[c].alias(c)
        for c, kind in docs.dtypes
    ]
    return with_spans.withColumn("text", clean).select(*columns)
