"""Operator 4: URL filter.

Host rules decide first; where none fits, a logistic regression on hashed
character n-grams of host and path does, trained from a small labelled table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
NGRAMS = (3, 4, 5)
# Bounds of what is sent to every worker.
MAX_RULES = 200_000
MAX_LABELLED = 20_000

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path). The host follows the first ``://``, A-Z lower-cased; a null or other url has neither."""
    found = _URL.search(url) if url else None
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


def features(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams of host and path, each with its border marks and its own prefix."""
    grams = set()
    for mark, part in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in NGRAMS:
            grams.update(mark + part[i : i + n] for i in range(max(1, len(part) - n + 1)))
    return np.fromiter((zlib.crc32(g.encode("utf-8", "replace")) % BUCKETS for g in grams), np.int64, len(grams))


@dataclass(frozen=True)
class UrlModel:
    """Weights of the hashed n-grams; ``threshold`` is the probability from which a url is blocked."""

    weights: np.ndarray
    bias: float
    threshold: float = 0.5

    def block_probability(self, host: str, path: str) -> float:
        found = features(host, path)
        z = float(self.weights[found].sum() / np.sqrt(len(found))) + self.bias
        return 1.0 / (1.0 + float(np.exp(-np.clip(z, -35, 35))))


def fit_urls(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked") -> UrlModel:
    """Train from a table of (url, blocked 0/1) with at most ``MAX_LABELLED`` rows; more is an error.

    Null labels take no part, repeated urls count once per label. Without rows,
    or with one class only, the bias alone decides (allow if there are no rows).
    """
    rows = (
        labelled.select(F.col(url_col).alias("url"), F.col(label_col).cast("int").alias("blocked"))
        .where(F.col("blocked").isNotNull())
        .distinct()
        .limit(MAX_LABELLED + 1)
        .collect()
    )
    if len(rows) > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled urls")
    rows = sorted((r["url"] or "", int(r["blocked"])) for r in rows)
    y = np.array([float(b) for _, b in rows])
    if not rows or y.min() == y.max():
        return UrlModel(np.zeros(BUCKETS), 10.0 if rows and y[0] else -10.0)
    sparse = [features(*split_url(url)) for url, _ in rows]
    owner = np.repeat(np.arange(len(rows)), [len(f) for f in sparse])
    flat, size = np.concatenate(sparse), np.sqrt([len(f) for f in sparse])
    weights, bias = np.zeros(BUCKETS), 0.0
    for step in range(400):
        z = np.bincount(owner, weights[flat], len(rows)) / size + bias
        error = (1.0 / (1.0 + np.exp(-np.clip(z, -35, 35))) - y) / len(rows)
        gradient = np.bincount(flat, (error / size)[owner], BUCKETS)
        rate = 8.0 / (1.0 + step / 200)
        weights -= rate * (gradient + 1e-4 * weights)
        bias -= rate * error.sum()
    return UrlModel(weights, float(bias))


class Rules:
    """Allow and block rules by host and path; the longest rule that fits wins."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        """Pairs (``host/path``, verdict). Of equal rules the last one counts."""
        self.by_host: dict[str, dict[str, tuple[str, str]]] = {}
        n = 0
        for rule, verdict in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict must be allow or block, got {verdict!r}")
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, {})[slash + path] = (rule, verdict)
            n += 1
        if n > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules")
        self.lengths = {host: sorted({len(p) for p in paths}) for host, paths in self.by_host.items()}

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        while host:
            paths = self.by_host.get(host)
            if paths:
                for length in reversed(self.lengths[host]):
                    found = paths.get(path[:length]) if length <= len(path) else None
                    if found:
                        if best is None or len(found[0]) > len(best[0]):
                            best = found
                        break
            host = host.partition(".")[2]
        return best


def judge_url(url: Column, rules: Rules, model: UrlModel) -> Column:
    """A struct (host, path, rule, probability, verdict) for every url.

    A url that is null, empty or without ``://`` has an empty host and path; no
    rule fits it and the model judges it like any other.
    """
    kinds = "struct<host:string,path:string,rule:string,probability:double,verdict:string>"

    @F.arrow_udf(kinds)
    def judge(column: pa.Array) -> pa.Array:
        hosts, paths, named, odds, verdicts = [], [], [], [], []
        for value in column.to_pylist():
            host, path = split_url(value)
            rule = rules.find(host, path)
            p = model.block_probability(host, path)
            hosts.append(host)
            paths.append(path)
            named.append(rule[0] if rule else None)
            odds.append(p)
            verdicts.append(rule[1] if rule else "block" if p >= model.threshold else "allow")
        columns = [pa.array(c, pa.string()) for c in (hosts, paths, named)]
        columns += [pa.array(odds, pa.float64()), pa.array(verdicts, pa.string())]
        return pa.StructArray.from_arrays(columns, names=["host", "path", "rule", "probability", "verdict"])

    return judge(url)
