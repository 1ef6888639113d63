"""URL filters: allow and block entries in a trie over reversed host labels and path segments.

The longest entry that fits a URL decides, whichever list it stands on; of two equally long ones, which can only be
the same entry on both lists, the block wins.  A URL that no entry fits gets the default verdict.  A null URL, or one
without `://`, has an empty host and path, and no entry fits it.  Repeated rows are judged alike, extra columns are
kept.  The rules are part of the operator's configuration: the trie is broadcast once and refused above `MAX_BYTES`.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskrank.llm.frames import free_name

#: Largest pickled trie that is sent to the executors.
MAX_BYTES = 256 << 20

VERDICT = T.StructType([T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "verdict")])
_FIELDS = [pa.field(n, pa.string()) for n in ("host", "path", "rule", "verdict")]


class UrlTrie:
    """Labels of the host from the last to the first; below each label a trie of whole path segments.

    A path node holds the entries that end there: by the beginning of the next segment that they ask for.
    """

    def __init__(self, entries: Iterable[tuple[str, str, str]]):
        self.root: dict = {"sub": {}, "paths": None}
        for verdict, host, path in entries:
            if verdict not in ("allow", "block") or not host:
                raise ValueError(f"not an entry: {(verdict, host, path)}")
            node = self.root
            for label in reversed(host.lower().split(".")):
                node = node["sub"].setdefault(label, {"sub": {}, "paths": None})
            node["paths"] = node["paths"] or {"sub": {}, "ends": {}}
            node, (*whole, rest) = node["paths"], path.split("/")
            for segment in whole:
                node = node["sub"].setdefault(segment, {"sub": {}, "ends": {}})
            found = (len(host) + len(path), verdict == "block", host + path, verdict)
            node["ends"][rest] = max(found, node["ends"].get(rest, found))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule and verdict of the longest entry that fits."""
        best, node = None, self.root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node["sub"].get(label)
            if node is None:
                break
            if node["paths"] is not None:
                best = max(filter(None, (best, *self._paths(node["paths"], segments))), default=None)
        return best and best[2:]

    @staticmethod
    def _paths(node: dict, segments: list[str]) -> Iterator[tuple]:
        for segment in segments:
            for rest, found in node["ends"].items():
                if segment.startswith(rest):
                    yield found
            node = node["sub"].get(segment)
            if node is None:
                return


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without `://`."""
    _, sign, rest = (url or "").partition("://")
    if not sign:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), tail[:stop]


def filter_urls(pages: DataFrame, entries: Iterable[tuple[str, str, str]], default: str = "allow", url: str = "url",
                into: str = "url_verdict") -> DataFrame:
    """All rows and columns of `pages` with a struct of host, path, rule and verdict as one more, last column.

    `entries` are (allow or block, host, path prefix).  The struct is called `into`, or so with underscores in front
    if that name is taken.
    """
    trie = UrlTrie(entries)
    if (size := len(pickle.dumps(trie))) > MAX_BYTES:
        raise ValueError(f"the rules take {size} bytes; {MAX_BYTES} are the most that is broadcast")
    shared = pages.sparkSession.sparkContext.broadcast(trie)
    at = pages.columns.index(url)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = [split_url(u) for u in batch.column(at).to_pylist()]
            found = [shared.value.find(*u) if u[0] else None for u in urls]
            parts = ([u[0] for u in urls], [u[1] for u in urls], [f and f[0] for f in found],
                     [f[1] if f else default for f in found])
            struct = pa.StructArray.from_arrays([pa.array(p, pa.string()) for p in parts], fields=_FIELDS)
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, name])

    name = free_name(pages, into)
    return (pages.withColumn(url, F.col(url).cast("string"))
            .mapInArrow(judge, T.StructType([*pages.schema.fields, T.StructField(name, VERDICT)])))
