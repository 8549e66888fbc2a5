"""Secret scan: trigram queries derived from each rule pick candidate texts, which are then verified."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrow
from .common import table

# An OR of ANDs of trigrams. The empty AND holds for every text: the rule has no mandatory trigram.
Query = frozenset[frozenset[str]]
ALL: Query = frozenset([frozenset()])
# Sets of literal strings and queries are given up beyond these sizes; that only widens a query.
MOST_STRINGS = 64
WIDEST_CLASS = 4


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters, or the match is dropped."""

    kind: str
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 1


# The kinds and patterns of the base.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 0, 24),
)
MORE_RULES = (
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,2}PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES
BASE_KINDS = tuple(r.kind for r in BASE_RULES)


def _simplify(query: set[frozenset[str]]) -> Query:
    """An AND that contains another one adds nothing."""
    if len(query) > MOST_STRINGS:
        return ALL
    return frozenset(a for a in query if not any(b < a for b in query))


def _both(a: Query, b: Query) -> Query:
    joined = {x | y for x in a for y in b}
    return _simplify(joined) if len(joined) <= MOST_STRINGS else a


def _of_strings(strings: set[str]) -> Query:
    return _simplify({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _strings(node) -> set[str] | None:
    """The strings that a piece of a pattern stands for, in lower case; None if they are too many."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN:
        chars: set[str] = set()
        for what, which in value:
            if what is op.LITERAL:
                chars.add(chr(which).lower())
            elif what is op.RANGE and which[1] - which[0] < WIDEST_CLASS:
                chars |= {chr(c).lower() for c in range(which[0], which[1] + 1)}
            else:
                return None
        return chars if len(chars) <= WIDEST_CLASS + 1 else None
    if kind is op.SUBPATTERN:
        return _all_strings(value[-1])
    if kind is op.BRANCH:
        found = [_all_strings(b) for b in value[1]]
        return None if None in found else set().union(*found)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] <= 2:
        once = _all_strings(value[2])
        if once is None:
            return None
        out, power = set(), {""}
        for times in range(value[1] + 1):
            if times >= value[0]:
                out |= power
            power = {a + b for a in power for b in once}
        return out
    return {""} if kind is op.AT else None


def _all_strings(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        more = _strings(node)
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _query(nodes) -> Query:
    """Trigrams that every match of a pattern's nodes must contain."""
    query, literal = ALL, {""}
    for node in nodes:
        more = _strings(node)
        if more is not None and len(literal) * len(more) <= MOST_STRINGS:
            literal = {a + b for a in literal for b in more}
            continue
        query, literal = _both(query, _of_strings(literal)), more if more is not None and len(more) <= MOST_STRINGS else {""}
        if more is None:
            kind, value = node
            if kind is op.SUBPATTERN:
                query = _both(query, _query(value[-1]))
            elif kind is op.BRANCH:
                query = _both(query, _simplify({a for b in value[1] for a in _query(b)}))
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
                query = _both(query, _query(value[2]))
    return _both(query, _of_strings(literal))


def trigram_query(rule: Rule) -> Query:
    """What the lower-case text must contain for the rule to match; ``ALL`` if that says nothing."""
    return _query(parser.parse(rule.pattern, rule.flags))


class Index:
    """Postings of the queried trigrams over the texts of one block, and the candidates of each rule."""

    def __init__(self, queries: Mapping[str, Query]):
        self.queries = queries
        self.trigrams = sorted({t for q in queries.values() for a in q for t in a})

    def candidates(self, texts: Sequence[str]) -> dict[str, list[int]]:
        postings: dict[str, set[int]] = {t: set() for t in self.trigrams}
        for row, text in enumerate(texts):
            low = text.lower()
            for t in self.trigrams:
                if t in low:
                    postings[t].add(row)
        everything = range(len(texts))
        return {
            kind: list(everything)
            if frozenset() in query
            else sorted(set().union(*(set.intersection(*(postings[t] for t in a)) for a in query)))
            for kind, query in self.queries.items()
        }


def scan_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: (kind, start, end) of each secret, in code points, by start and order of rules.

    Texts are indexed in blocks where they lie, so nothing is shuffled; a block's postings hold only trigrams
    that some rule asks for. Matches of one rule are leftmost and don't overlap; those of different rules
    may. A null text has no secrets; an existing column ``spans`` is replaced. Whole texts are scanned, and
    one text is the smallest block.
    """
    queries = {r.kind: trigram_query(r) for r in rules}

    @F.arrow_udf("array<struct<kind: string, start: int, end: int>>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(queries)
        compiled = [(r, re.compile(r.pattern, r.flags)) for r in rules]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans: list[list[tuple[int, int, str, int]]] = [[] for _ in range(len(batch))]
            for first, block in arrow.slices(batch):
                texts = block.to_pylist()
                candidates = index.candidates(texts)
                for order, (rule, pattern) in enumerate(compiled):
                    for row in candidates[rule.kind]:
                        for m in pattern.finditer(texts[row]):
                            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                                spans[first + row].append((m.start(), order, rule.kind, m.end()))
            yield pa.array(
                [[{"kind": k, "start": s, "end": e} for s, _, k, e in sorted(row)] for row in spans], kind
            )

    return docs.withColumn("spans", found(F.col(text)))


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op3_secrets(spark, sf_dir):
    """Secrets of every document: counts and digest of the base kinds, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs).drop("text")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(k) for k in BASE_KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
