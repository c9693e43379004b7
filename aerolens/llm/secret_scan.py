"""Secret scan (operator 3) over a trigram inverted index.

Every rule is a regular expression from which a Boolean trigram query is
derived: the literal trigrams that each match must hold, AND within a
sequence, OR between alternatives. Every block of documents is indexed by
trigram (postings: the documents that hold it), the queries are evaluated on
postings, and only candidates are searched with the expression itself. A rule
without a mandatory trigram scans every document.

The index is made of blocks of consecutive rows, as a worker reads them:
nothing is shuffled and memory stays bounded by the block. Matching is on
characters, ASCII-only classes. Null texts count as empty and hold no secret.
Each row gives a row, ids repeated or null included. An empty table gives no
rows, a very long text is a block of its own and searched whole, other columns
are not read. Spans that start together stand in the order of the rules.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

try:  # Python 3.11 renamed it
    from re import _constants as sre
    from re import _parser as parser
except ImportError:  # pragma: no cover
    import sre_constants as sre
    import sre_parse as parser

from aerolens.llm.common import LOWER, Block, blocks, documents, text_array


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    any_case: bool = False
    part: int = 0
    least: int = 1  # characters of the part

    def matches(self, text: str) -> Iterator[tuple[int, int]]:
        for found in self.expression().finditer(text):
            if len(found[self.part]) >= self.least:
                yield found.span()

    def expression(self) -> re.Pattern:
        return _expression(self.pattern, self.any_case)


@lru_cache
def _expression(pattern: str, any_case: bool) -> re.Pattern:
    return re.compile(pattern, re.ASCII | (re.IGNORECASE if any_case else 0))


# The base rules, and public formats of access tokens.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        any_case=True,
        part=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
)

# ----------------------------------------------------------- trigram queries

#: ("all",), ("any_of", queries), ("all_of", queries) or ("has", trigram)
Query = tuple
EVERY: Query = ("all",)
#: Most strings that an exact set may hold before it is given up for its query.
MOST = 40


def _both(*queries: Query) -> Query:
    kept = tuple(dict.fromkeys(q for q in queries if q != EVERY))
    return EVERY if not kept else kept[0] if len(kept) == 1 else ("all_of", kept)


def _either(*queries: Query) -> Query:
    kept = tuple(dict.fromkeys(queries))
    return EVERY if not kept or EVERY in kept else kept[0] if len(kept) == 1 else ("any_of", kept)


def _of_strings(strings: set[str]) -> Query:
    return _either(
        *(_both(*(("has", s[i : i + 3]) for i in range(len(s) - 2))) for s in strings)
    )


def _walk(items) -> tuple[set[str] | None, Query]:
    """All strings that a parsed sequence matches (None: too many or unknown),
    and the query implied by what was given up on the way."""
    exact: set[str] | None = {""}
    runs: list[Query] = []

    def flush() -> None:
        nonlocal exact
        if exact:
            runs.append(_of_strings(exact))
        exact = {""}

    for op, value in items:
        strings, query = None, EVERY
        if op is sre.LITERAL:
            strings = {chr(value)}
        elif op is sre.SUBPATTERN:
            strings, query = _walk(value[3])
        elif op is sre.BRANCH:
            found = [_walk(x) for x in value[1]]
            if all(s is not None for s, _ in found):
                strings = set().union(*(s for s, _ in found))
            else:
                query = _either(*(_both(q, _of_strings(s)) if s is not None else q for s, q in found))
        elif op is sre.IN:
            if all(o is sre.LITERAL for o, _ in value):
                strings = {chr(v) for _, v in value}
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, inner = value
            one, query = _walk(inner)
            if one is not None and most == 1:
                strings = one | {""} if least == 0 else one
            elif least == 0:
                query = EVERY
            elif one is not None:
                query = _of_strings(one)
        elif op is sre.AT:
            strings = {""}
        runs.append(query)
        if strings is not None and exact is not None and len(strings) * len(exact) <= MOST:
            exact = {a + b for a in exact for b in strings}
        else:
            flush()
            if strings is not None and len(strings) <= MOST:
                exact = set(strings)
    if runs and any(q != EVERY for q in runs) or _unknown(items):
        return None, _both(*runs, _of_strings(exact))
    return exact, EVERY


def _unknown(items) -> bool:
    """Whether a sequence holds something that isn't spelled out in full."""
    for op, value in items:
        if op is sre.IN and not all(o is sre.LITERAL for o, _ in value):
            return True
        if op in (sre.ANY, sre.NOT_LITERAL, sre.CATEGORY):
            return True
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and (value[1] != 1 or _unknown(value[2])):
            return True
        if op is sre.SUBPATTERN and _unknown(value[3]):
            return True
        if op is sre.BRANCH and any(_unknown(x) for x in value[1]):
            return True
        if op not in (sre.LITERAL, sre.IN, sre.MAX_REPEAT, sre.MIN_REPEAT, sre.SUBPATTERN, sre.BRANCH, sre.AT):
            return True
    return False


@lru_cache
def trigram_query(pattern: str) -> Query:
    """The Boolean query, over lower-case trigrams, that any match implies."""
    strings, query = _walk(parser.parse(pattern.lower() if "\\" not in pattern else _lower_literals(pattern)))
    return _both(query, _of_strings(strings)) if strings is not None else query


def _lower_literals(pattern: str) -> str:
    """Lower-cases letters that aren't part of an escape."""
    return re.sub(r"\\.|[A-Z]", lambda m: m[0] if m[0][0] == "\\" else m[0].lower(), pattern)


def trigrams_of(query: Query) -> set[str]:
    if query[0] == "has":
        return {query[1]}
    return set().union(*map(trigrams_of, query[1])) if len(query) > 1 else set()


class TrigramIndex:
    """Postings of the trigrams that the queries ask for, over one block."""

    def __init__(self, block: Block, wanted: list[str]):
        self.rows = block.rows
        codes = [int.from_bytes(t.encode(), "big") for t in wanted]
        order = np.argsort(codes)
        held = np.array(codes, np.uint32)[order]
        maybe = np.zeros(1 << 16, bool)
        maybe[held & 0xFFFF] = True
        data = LOWER[block.data]
        self.postings = {t: np.zeros(0, np.int64) for t in wanted}
        if len(data) < 3 or not len(held):
            return
        low = data[1:-1].astype(np.uint16) << 8 | data[2:]
        at = np.flatnonzero(maybe[low])
        code = data[at].astype(np.uint32) << 16 | low[at]
        where = np.searchsorted(held, code)
        where[where == len(held)] = 0
        row = np.searchsorted(block.ends, at, "right") - 1
        good = (held[where] == code) & (at + 3 <= block.ends[row + 1])
        pairs = np.unique(where[good] * np.int64(block.rows) + row[good])
        for k, t in zip(range(len(held)), np.array(wanted)[order].tolist(), strict=True):
            own = pairs[np.searchsorted(pairs, k * block.rows) : np.searchsorted(pairs, (k + 1) * block.rows)]
            self.postings[t] = own - k * block.rows

    def rows_of(self, query: Query) -> np.ndarray:
        if query == EVERY:
            return np.arange(self.rows)
        if query[0] == "has":
            return self.postings[query[1]]
        found = [self.rows_of(q) for q in query[1]]
        step: Callable = np.intersect1d if query[0] == "all_of" else np.union1d
        out = found[0]
        for more in found[1:]:
            out = step(out, more)
        return out


def secrets(
    df: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and spans: kind, start and end (characters, end exclusive) of
    every match, by start, then in the rules' order."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigram_query(r.pattern) for r in rules]
        wanted = sorted(set().union(*map(trigrams_of, queries)))
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            out: list[list] = []
            texts = text_array(batch)
            for block in blocks(texts, 1 << 20):
                index = TrigramIndex(block, wanted)
                found: list[list] = [[] for _ in range(block.rows)]
                kept: dict[int, str] = {}
                for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
                    for row in index.rows_of(query).tolist():
                        text = kept.get(row) or kept.setdefault(row, block.text(row).decode("utf-8", "replace"))
                        found[row] += [(s, k, e) for s, e in rule.matches(text)]
                out += [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in sorted(x)] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(span))], ["doc_id", "spans"])

    schema = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
    return documents(df, id_col, text_col).mapInArrow(scan, schema)
