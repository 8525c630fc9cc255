"""URL rules by a sorted digest array (operator 2).

A rule is ``host/path``. It fits its host and every subdomain when the path of the URL starts with the rule's path;
of several fitting rules the longest wins. Rules are kept as a sorted array of 64-bit xxhash digests of ``host + path``
beside the full strings. A worker maps the array from a file and probes all keys of a batch (every host suffix times
every path length that occurs among the rules) with one vectorised binary search; a hit counts only when the stored
full string equals the key, so that digest collisions do no harm.

Defined results: a null URL or one without ``://`` has an empty host and path; it fits no rule and gets the default
verdict. Equal rules with different actions: ``block`` holds. Of two fitting rules of the same length the one with the
longer host wins. Other columns of the input are ignored, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ACTIONS = ("allow", "block")
#: The digest array is broadcast; a longer list of rules is joined instead (``judge_by_join``).
MAX_RULES = 5_000_000


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, rest = rule.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + rest


def build_index(rules: Iterable[tuple[str, str]]) -> dict:
    """rules: pairs of action and rule. Returns the parts of the digest array, sorted by digest."""
    kept: dict[str, int] = {}
    hosts: dict[str, str] = {}
    for action, rule in rules:
        host, path = split_rule(rule)
        kept[host + path] = max(kept.get(host + path, 0), ACTIONS.index(action))
        hosts[host + path] = host
    if len(kept) > MAX_RULES:
        raise ValueError(f"{len(kept)} rules; beyond {MAX_RULES} use judge_by_join")
    keys = sorted(kept, key=lambda k: (xxhash.xxh64_intdigest(k), k))
    raw = [k.encode() for k in keys]
    ends = np.cumsum([0, *map(len, raw)]).astype(np.uint64)
    parts = [
        np.array([xxhash.xxh64_intdigest(k) for k in raw], np.uint64).tobytes(), ends.tobytes(),
        np.array([len(hosts[k].encode()) for k in keys], np.uint32).tobytes(), np.array([kept[k] for k in keys], np.uint8).tobytes(), b"".join(raw),
    ]
    return {
        "n": len(keys), "data": b"".join(parts), "name": xxhash.xxh128_hexdigest(b"".join(parts)),
        "path_lengths": sorted({len(k) - len(hosts[k]) for k in keys}), "labels": max((hosts[k].count(".") + 1 for k in keys), default=0),
    }


class DigestArray:
    """The array of ``build_index``, mapped from a file of this worker's own that has no name any more."""

    def __init__(self, index: dict) -> None:
        n = index["n"]
        self.path_lengths, self.labels, self.n = index["path_lengths"], index["labels"], n
        with tempfile.TemporaryFile() as f:
            f.write(index["data"] or b"\0")
            f.flush()
            at = np.memmap(f, np.uint8, "r")
        self.digests = at[: 8 * n].view(np.uint64)
        self.ends = at[8 * n : 16 * n + 8].view(np.uint64) if n else np.zeros(1, np.uint64)
        self.host_len = at[16 * n + 8 : 20 * n + 8].view(np.uint32)
        self.action = at[20 * n + 8 : 21 * n + 8]
        self.blob = at[21 * n + 8 :]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The place of each key in the array, -1 where it isn't there."""
        out = np.full(len(keys), -1, np.int64)
        if not self.n or not keys:
            return out
        d = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        lo = np.searchsorted(self.digests, d)
        for i in np.flatnonzero((lo < self.n) & (self.digests[np.minimum(lo, self.n - 1)] == d)).tolist():
            j = int(lo[i])
            while j < self.n and self.digests[j] == d[i]:  # more than one round only for colliding digests
                if self.blob[int(self.ends[j]) : int(self.ends[j + 1])].tobytes() == keys[i]:
                    out[i] = j
                    break
                j += 1
        return out

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
        """The winning rule and its action for each URL, or None."""
        keys: list[bytes] = []
        owner: list[int] = []
        for i, (h, p) in enumerate(zip(hosts, paths, strict=True)):
            labels = h.split(".")
            suffixes = [".".join(labels[k:]) for k in range(max(0, len(labels) - self.labels), len(labels))] if h else []
            for n in self.path_lengths:
                if n > len(p):
                    break
                head = p[:n]
                keys += [(s + head).encode("utf-8", "surrogatepass") for s in suffixes]
                owner += [i] * len(suffixes)
        best: list[tuple[int, int, int] | None] = [None] * len(hosts)
        place = self.find(keys)
        for k in np.flatnonzero(place >= 0).tolist():
            j = int(place[k])
            text = keys[k].decode()
            rank = (len(text), int(self.host_len[j]), j)
            if best[owner[k]] is None or rank > best[owner[k]]:
                best[owner[k]] = rank
        return [None if b is None else (self.blob[int(self.ends[b[2]]) : int(self.ends[b[2] + 1])].tobytes().decode(), ACTIONS[self.action[b[2]]]) for b in best]


_loaded: dict[str, DigestArray] = {}


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row. The URL is split by Spark; only its parts reach Python."""
    made = build_index(rules)
    index, key = pages.sparkSession.sparkContext.broadcast(made), made["name"]  # workers know an array by what it holds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _loaded:
            _loaded.clear()
            _loaded[key] = DigestArray(index.value)
        array = _loaded[key]
        for b in batches:
            found = array.judge(b.column("host").to_pylist(), b.column("path").to_pylist())
            rule = pa.array([f and f[0] for f in found], pa.string())
            verdict = pa.array([f[1] if f else default for f in found], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, rule, verdict], names=[*b.schema.names, "rule", "verdict"])

    parts = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    kind = dict(parts.dtypes)[id_col]
    return parts.mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


def judge_by_join(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """The same for a table ``action, rule`` of any length: keys meet rules in an equi-join instead of a broadcast array."""
    r = rules.select(
        F.translate(F.regexp_extract("rule", r"(?s)^([^/]*)", 1), UPPER, LOWER).alias("_rh"),
        F.regexp_extract("rule", r"(?s)^[^/]*(.*)", 1).alias("_rp"), "action",
    ).groupBy("_rh", "_rp").agg(F.max("action").alias("action"))
    u = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    labels = F.split("host", r"\.")
    keys = u.select("host", "path").distinct().withColumn("_rh", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))))
    hit = keys.join(r, "_rh").filter(F.startswith("path", F.col("_rp"))).groupBy("host", "path").agg(
        F.max_by(F.struct(F.concat("_rh", "_rp").alias("rule"), "action"), F.struct(F.length(F.concat("_rh", "_rp")), F.length("_rh"))).alias("_w")
    )
    return u.join(hit, ["host", "path"], "left").select(id_col, "host", "path", F.col("_w.rule").alias("rule"), F.coalesce("_w.action", F.lit(default)).alias("verdict"))
