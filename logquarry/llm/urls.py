"""URL filter (operator 2): a trie over reversed host labels, then path segments, with the longest match winning.

A rule is a host and the beginning of a path, such as ``example.net/en/``. It fits its host and all
subdomains, when the url's path starts with the rule's. Walking the trie, a deeper host wins over a
shallower one and, on one host, a longer path over a shorter; where the same rule is both allowed and
blocked, block wins. A url that no rule fits gets the default verdict.

The trie is broadcast. Rules are a parameter, not data, but may be many: beyond ``rules_per_trie`` they are
split over several tries, each a pass of its own over the urls that keeps the better match so far.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
RULES_PER_TRIE = 200_000  # some hundred bytes each

# The rules of the registered query.
RULES = [(BLOCK, "net", "/"), (ALLOW, "example.net", "/en/"), (BLOCK, "example.com", "/de/"), (ALLOW, "org", "/fr/")]

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:end].translate(_LOWER), rest[end:]
    return host, rest[: min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))]


class _Node:
    """A step by a whole label or segment; ``ends`` are rules ending here by the start of the next segment."""

    __slots__ = ("labels", "segments", "ends", "sizes")

    def __init__(self):
        self.labels, self.segments, self.ends, self.sizes = {}, {}, {}, ()


def build_trie(rules: list[tuple[str, str, str]]) -> _Node:
    """``rules`` are (verdict, host, path); a path is compared from its first character, so ``/`` fits all with a path."""
    root = _Node()
    for verdict, host, path in rules:
        if verdict not in (ALLOW, BLOCK):
            raise ValueError(f"verdict must be {ALLOW} or {BLOCK}: {verdict}")
        host = host.translate(_LOWER)
        node = root
        for label in reversed(host.split(".")):
            node = node.labels.setdefault(label, _Node())
        *whole, last = path.split("/")
        for segment in whole:
            node = node.segments.setdefault(segment, _Node())
        if node.ends.get(last, ("", ""))[1] != BLOCK:
            node.ends[last] = (host + path, verdict)
        node.sizes = tuple(sorted({len(end) for end in node.ends}, reverse=True))
    return root


def match(trie: _Node, host: str, path: str) -> tuple[int, int, str, str] | None:
    """The longest fitting rule as (host labels, path characters, rule, verdict)."""
    best, node, segments = None, trie, None
    for depth, label in enumerate(reversed(host.split(".")), 1):
        node = node.labels.get(label)
        if node is None:
            break
        if not node.ends and not node.segments:
            continue
        segments = path.split("/") if segments is None else segments
        inner, size = node, 0
        for segment in segments:
            for n in inner.sizes:
                if n <= len(segment) and segment[:n] in inner.ends:
                    best = (depth, size + n, *inner.ends[segment[:n]])
                    break
            inner = inner.segments.get(segment)
            if inner is None:
                break
            size += len(segment) + 1
    return best


def _judge(batches: Iterator[pa.RecordBatch], trie: _Node) -> Iterator[pa.RecordBatch]:
    """(id, host, path, depth, size, rule, verdict) with the better of the match so far and this trie's."""
    for batch in batches:
        columns = batch.to_pydict()
        known = {}
        rows = list(zip(columns["host"], columns["path"], columns["depth"], columns["size"], columns["rule"], columns["verdict"]))
        for i, (host, path, *before) in enumerate(rows):
            if (host, path) not in known:
                known[host, path] = match(trie, host, path)
            now = known[host, path]
            old = (before[0], before[1], before[3] == BLOCK)
            rows[i] = now if now and (now[0], now[1], now[3] == BLOCK) > old else tuple(before)
        depth, size, rule, verdict = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(depth, pa.int32()), pa.array(size, pa.int32()), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
            names=["id", "host", "path", "depth", "size", "rule", "verdict"],
        )


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = ALLOW,
    rules_per_trie: int = RULES_PER_TRIE,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule (null when none fits) and verdict.

    A null url, or one without ``://``, has an empty host and path and fits no rule with a host. Repeated
    rows and null ids are each judged; other columns are ignored. Without rules all get ``default``.
    """
    url = F.coalesce(F.col(f"`{url_column}`").cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, "(?s)^.*?://", "")).otherwise("")
    host = F.translate(F.regexp_extract(rest, "(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    df = pages.select(
        F.col(f"`{id_column}`").alias("id"),
        host.alias("host"),
        F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1).alias("path"),
        F.lit(0).alias("depth"),
        F.lit(0).alias("size"),
        F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("verdict"),
    )
    kind = df.schema["id"].dataType.simpleString()
    for i in range(0, len(rules), rules_per_trie):
        trie = df.sparkSession.sparkContext.broadcast(build_trie(rules[i : i + rules_per_trie]))

        def judge(batches, trie=trie):
            return _judge(batches, trie.value)

        df = df.mapInArrow(judge, f"id {kind}, host string, path string, depth int, size int, rule string, verdict string")
    return df.select(F.col("id").alias("page_id"), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op2_url_filter(spark, sf_dir) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES)


OP2_SQL = r"""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
 h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
       regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
 r AS (SELECT page_id, host, path, CASE
       WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
       WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
       WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
       WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
