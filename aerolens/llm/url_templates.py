"""URL filter by rules and path-template trees (operator 13).

Rules of a host and a path prefix decide the urls they fit. For the others the
urls of each host grow a tree of path templates, level by level in Spark:

- numbers and long hexadecimal names in a path become wildcards by their form;
- of a node's segments those are constants that hold at least ``constant_share``
  of its urls (and ``least_urls``); all others are variable and become ``*``, one
  branch. A node thus has at most ``1 / constant_share`` constants;
- constants whose branches are alike, in how their urls are labelled and in what
  kind of segment comes next, merge into one branch. Alike means: the add-one
  smoothed shares differ by at most ``similar`` in total variation, so the test
  means the same at every size of the corpus. The largest constant comes first
  (ties by name), and each further one joins the first branch that it is like;
- urls that end in one node share a template. The labelled urls, those that a
  rule decides, give its purity: ``(blocked + strength * prior) / (labelled +
  strength)``. A template whose purity reaches ``reject`` is blocked, any other
  allowed, so a template without labels never goes.

Urls are counted by host and path form first, so a host with a third of all urls
is a few rows wherever its paths repeat, and where they don't every aggregate
has partial sums and every join is salted or has a broadcast side whose bytes
were counted. Segments beyond ``max_depth`` count as one tail, ``**``.

A null url, or one without ``://``, has an empty host and path, which no rule
fits; it belongs to the template of the empty path and is allowed. Rows are
separate whatever their id: a null id stays null, repeated rows all come back
(and count each). An empty table gives no rows. A very long url is one path like
any other. Of rules that fit, the longest written wins; of equally long ones
that with the longer host, then the first listed. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolens.llm.common import checkpoint, column

#: Bytes of join keys up to which a side is broadcast, and parts of hot keys beyond.
BROADCAST_BYTES, SALTS = 4 << 20, 16
#: A tail of segments too deep, and any variable segment.
TAIL, ANY = "**", "*"
#: What comes after a segment: nothing, an empty segment, one with a wildcard, another one.
KINDS = ("ends", "slash", "number", "word")
STATES = ("allowed", "blocked", "open")


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Tree:
    """Parameters of the template tree."""

    constant_share: float = 0.02
    least_urls: int = 4
    similar: float = 0.15
    max_depth: int = 8
    strength: float = 4.0
    prior: float = 0.5
    reject: float = 0.8


# ------------------------------------------------------------------ host and path


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def deciding_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The name and the verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    order = sorted(range(len(rules)), key=lambda k: (len(rules[k].name), len(rules[k].host), -k))
    for rule in (rules[k] for k in order):  # the last one that fits decides
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def path_form(path: Column) -> Column:
    """The path with wildcards for hexadecimal names of eight or more characters
    that hold a digit, and for numbers."""
    hexadecimal = r"(?<![0-9A-Za-z])(?=[a-fA-F-]*[0-9])[0-9a-fA-F][0-9a-fA-F-]{6,}[0-9a-fA-F](?![0-9A-Za-z])"
    plain = r"(?<![0-9A-Za-z])[0-9]+(?![0-9A-Za-z])"
    marked = F.regexp_replace(path, plain, "{n}")
    return F.regexp_replace(F.regexp_replace(marked, hexadecimal, "{h}"), "[0-9]+", "{n}")


# ------------------------------------------------------------------------- trees


def _joined(left: DataFrame, right: DataFrame, keys: list[str], spread: str, how: str = "left") -> DataFrame:
    """``left`` with ``right`` (checkpointed, unique by ``keys``): broadcast if the
    bytes counted are few; else the rows of each key of ``left`` are dealt to
    ``SALTS`` places by the column ``spread``, and ``right`` goes to each."""
    size = F.sum(sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in right.columns), F.lit(64)))
    if (right.agg(size).first()[0] or 0) <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), keys, how)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return salted.join(right.withColumn("_salt", salts), [*keys, "_salt"], how).drop("_salt")


def _segment(depth: int, max_depth: int) -> Column:
    """The segment of ``form`` at a depth from 0, null where the path has ended."""
    if depth == max_depth:
        return F.when(F.size(F.split("form", "/", -1)) > depth + 1, F.lit(TAIL))
    return F.try_element_at(F.split("form", "/", -1), F.lit(depth + 2))


def _kind(segment: Column) -> Column:
    return (
        F.when(segment.isNull(), "ends").when(segment == "", "slash").when(segment.contains("{"), "number").otherwise("word")
    )


def apart(a: Sequence[int], b: Sequence[int]) -> float:
    """Total variation distance of two add-one smoothed distributions."""
    all_a, all_b = sum(a) + len(a), sum(b) + len(b)
    return sum(abs((x + 1) / all_a - (y + 1) / all_b) for x, y in zip(a, b, strict=True)) / 2


def merged(branches: list[dict], similar: float) -> dict[str, str]:
    """The branch, by name, that each of a node's constants goes to."""
    order = sorted(branches, key=lambda x: (-sum(x[s] for s in STATES), x["segment"]))
    lots: list[tuple[list[int], list[int], list[str]]] = []
    for x in order:
        state, kind = [x[s] for s in STATES], [x[k] for k in KINDS]
        for lot in lots:
            if apart(lot[0], state) <= similar and apart(lot[1], kind) <= similar:
                lot[0][:] = [p + q for p, q in zip(lot[0], state, strict=True)]
                lot[1][:] = [p + q for p, q in zip(lot[1], kind, strict=True)]
                lot[2].append(x["segment"])
                break
        else:
            lots.append((state, kind, [x["segment"]]))
    return {s: "|".join(sorted(names)) for _, _, names in lots for s in names}


def _branches(constants: DataFrame, similar: float) -> DataFrame:
    """(host, node, segment, branch) of constants, merged where they are alike; a
    node has at most 1 / constant_share of them."""
    nodes = constants.groupBy("host", "node").agg(F.collect_list(F.struct("segment", *STATES, *KINDS)).alias("branches"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, node, branches in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += [(host, node, s, b) for s, b in merged(branches, similar).items()]
            columns = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in columns], ["host", "node", "segment", "branch"]
            )

    return nodes.mapInArrow(run, "host string, node string, segment string, branch string")


def _grown(forms: DataFrame, tree: Tree) -> DataFrame:
    """``forms`` (host, form and numbers of urls by state) with ``node``, the template of each."""
    rows = checkpoint(forms.withColumn("node", F.lit("")))
    deepest = rows.agg(F.max(F.size(F.split("form", "/", -1)))).first()[0] or 0
    total = sum(F.col(s) for s in STATES)
    for depth in range(min(deepest - 1, tree.max_depth + 1)):
        here = rows.withColumn("segment", _segment(depth, tree.max_depth))
        after = _kind(_segment(depth + 1, tree.max_depth)) if depth < tree.max_depth else F.lit("ends")
        there = here.where("segment is not null")
        nodes = checkpoint(there.groupBy("host", "node").agg(F.sum(total).alias("urls")))
        counted = there.withColumn("kind", after).groupBy("host", "node", "segment").agg(
            *(F.sum(s).alias(s) for s in STATES),
            *(F.sum(F.when(F.col("kind") == k, total).otherwise(0)).alias(k) for k in KINDS),
        )
        counted = counted.where(total >= tree.least_urls)
        constants = _joined(counted, nodes, ["host", "node"], "segment", "inner").where(
            total >= F.lit(tree.constant_share) * F.col("urls")
        )
        branches = checkpoint(_branches(constants, tree.similar))
        found = _joined(here, branches, ["host", "node", "segment"], "form")
        step = F.concat("node", F.lit("/"), F.coalesce("branch", F.lit(ANY)))
        rows = checkpoint(
            found.select(*forms.columns, F.when(F.col("segment").isNull(), F.col("node")).otherwise(step).alias("node"))
        )
    return rows


def _forms(urls: DataFrame) -> DataFrame:
    """Numbers of urls by host, path form and state."""
    state = F.coalesce("given", F.lit(""))
    return urls.groupBy("host", "form").agg(
        F.sum((state == "allow").cast("long")).alias("allowed"),
        F.sum((state == "block").cast("long")).alias("blocked"),
        F.sum((state == "").cast("long")).alias("open"),
    )


def _purity(grown: DataFrame, tree: Tree) -> DataFrame:
    """host, template, numbers of urls, purity and whether the template is rejected."""
    sums = grown.groupBy("host", "node").agg(*(F.sum(s).alias(s) for s in STATES))
    purity = (F.col("blocked") + tree.strength * tree.prior) / (F.col("allowed") + F.col("blocked") + tree.strength)
    return sums.select(
        "host", F.col("node").alias("template"), *STATES, purity.alias("purity"), (purity >= tree.reject).alias("rejected")
    )


def _urls(df: DataFrame, rules: Sequence[Rule], id_col: str, url_col: str) -> DataFrame:
    url = column(df, url_col).cast("string")
    host, path = host_and_path(url)
    urls = df.select(column(df, id_col).alias("id"), host.alias("host"), path.alias("path"))
    name, given = deciding_rule(rules, F.col("host"), F.col("path"))
    return urls.select("id", "host", "path", name.alias("rule"), given.alias("given"), path_form(F.col("path")).alias("form"))


def templates(
    df: DataFrame, rules: Sequence[Rule], tree: Tree = Tree(), id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """host, template, allowed, blocked, open, purity and rejected of every template."""
    return _purity(_grown(_forms(_urls(df, rules, id_col, url_col)), tree), tree)


def judge(
    df: DataFrame, rules: Sequence[Rule], tree: Tree = Tree(), id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """The id, host, path, rule (or null) and verdict of every row of ``df``."""
    urls = _urls(df, rules, id_col, url_col)
    grown = _grown(_forms(urls), tree)
    gone = _purity(grown, tree).where("rejected").select("host", F.col("template").alias("node"))
    # Only forms with urls that no rule decides are looked up.
    wanted = grown.where("open > 0").select("host", "node", "form")
    bad = checkpoint(_joined(wanted, checkpoint(gone), ["host", "node"], "form", "inner").select("host", "form"))
    # A url that a rule decides is no match, so it needs no lookup.
    look = F.when(F.col("rule").isNull(), F.col("form"))
    found = _joined(
        urls.withColumn("form", look), bad.withColumn("bad", F.lit(True)), ["host", "form"], "path"
    )
    verdict = F.coalesce("given", F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow")))
    return found.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))
