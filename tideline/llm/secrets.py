"""Secret scan with multipart credential linking.

Base spans, of every text, leftmost and non-overlapping for each kind:
``assign`` (a keyword, = or :, and a value of 6 or more), ``access`` (access
identifiers) and ``hex`` (long hexadecimal runs).

Weak candidates are only reported when complementary parts co-occur:

* ``key``: a bare token of 20 or more characters that mixes upper case, lower
  case and digits; reported if an access identifier, a login or an endpoint is
  near;
* ``login``: ``user=...`` and the like; reported if a secret (assign, hex or
  key) is near;
* ``endpoint``: a URL or host:port; reported if both a secret and an identifier
  (access or login) are near.

A scope is a block of a text between blank lines; near means in the same scope
with at most ``reach`` code points between the end of one part and the start of
the other, whichever comes first and however long they are.  The join of parts by
interval runs in Spark on bins of ``reach`` code points: a bin is summed up to the
first and last point of each role, so a scope full of parts makes no pairs.

Weak candidates that lie inside a base span are part of it and are not counted.
A null text is empty; repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import slices, staged

# The patterns of the base kinds and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the same spans as runs of 24 or more
KINDS = ("assign", "access", "hex", "key", "login", "endpoint")

TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}", re.ASCII)
LOGIN = re.compile(r"""(?:user(?:name)?|login|account|client_?id|access_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", re.IGNORECASE | re.ASCII)
ENDPOINT = re.compile(r"""[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{4,}|\b(?:[a-z0-9-]+\.)+[a-z]{2,}:[0-9]{2,5}\b""", re.IGNORECASE | re.ASCII)
BREAK = re.compile(r"\n[ \t\r]*\n")
#: Roles that a base or weak part plays, and roles that a weak part needs.
ROLES = {"assign": "secret", "hex": "secret", "key": "secret", "access": "identifier", "login": "identifier", "endpoint": "endpoint"}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), in the order they are listed in."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _mixed(token: str) -> bool:
    return any(c.isdigit() for c in token) and any(c.isupper() for c in token) and any(c.islower() for c in token)


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    found = [(m.start(), 3, m.end()) for m in TOKEN.finditer(text) if _mixed(m[0])]
    if ":" in text or "=" in text:
        found += [(m.start(), 4, m.end()) for m in LOGIN.finditer(text)]
        found += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    ends: list[tuple[int, int]] = [(s, e) for s, _, e in base]
    out, k = [], 0
    for start, kind, end in sorted(found):  # both are in order, so one sweep tells what lies inside
        while k < len(ends) and ends[k][1] <= start:
            k += 1
        if not any(s <= start and end <= e for s, e in ends[k : k + 3]):
            out.append((start, kind, end))
    return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCAN = "doc_id long, row binary, n_assign long, n_access long, n_hex long, base_sha256 string, base string, parts array<struct<scope:long,start:long,kind:int,end:long>>"
PART = pa.struct([("scope", pa.int64()), ("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])


def _scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "row", "n_assign", "n_access", "n_hex", "base_sha256", "base", "parts"]
    for part in slices(parts):
        rows, counts, digests, texts, linkable = [], ([], [], []), [], [], []
        for i, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
            text = text.as_py() or ""
            base = base_spans(text)
            weak = weak_spans(text, base)
            for k, own in enumerate(counts):
                own.append(sum(1 for s in base if s[1] == k))
            texts.append(listed(base))
            digests.append(hashlib.sha256(texts[-1].encode()).hexdigest())
            found = []
            if weak and len(base) + len(weak) > 1:  # a lone part has no complement
                breaks, scope = [m.start() for m in BREAK.finditer(text)], 0
                for s, k, e in sorted(base + weak):
                    while scope < len(breaks) and breaks[scope] < s:
                        scope += 1
                    found.append({"scope": scope, "start": s, "kind": k, "end": e})
            linkable.append(found or None)
            rows.append(hashlib.blake2b(f"{i}:{text}".encode("utf-8", "replace"), digest_size=16).digest() if found else None)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(rows, pa.binary()), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array(texts), pa.array(linkable, pa.list_(PART))],
            names=names,
        )


def _role(kind: Column) -> Column:
    return F.element_at(F.array(*(F.lit(ROLES[k]) for k in KINDS)), kind + 1)


def linked_parts(scanned: DataFrame, reach: int) -> DataFrame:
    """Weak parts whose complements are near: row, start, kind, end and the roles
    near it.

    A part is cut at the borders of the bins that it touches; of each bin, role
    and scope the least and greatest code point of such cuts are kept.  A weak part
    looks from ``reach`` before it to ``reach`` behind it: any cut in a bin inside
    that range is near, and in the bins at its two ends the least or greatest
    point tells.
    """
    parts = scanned.filter("parts IS NOT NULL").select("row", F.inline("parts")).dropDuplicates().withColumn("role", _role(F.col("kind")))
    bin_of = lambda x: F.floor(x / reach).cast("long")
    touched = parts.withColumn("bin", F.explode(F.sequence(bin_of(F.col("start")), bin_of(F.col("end") - 1))))
    cut = [F.greatest("start", F.col("bin") * reach), F.least("end", (F.col("bin") + 1) * reach)]
    bins = touched.groupBy("row", "scope", "bin", F.col("role").alias("near_role")).agg(F.min(cut[0]).alias("first"), F.max(cut[1]).alias("last"))
    weak = parts.filter(F.col("kind") >= 3).withColumns({"lo": F.col("start") - reach, "hi": F.col("end") + reach})
    weak = weak.withColumn("at", F.explode(F.sequence(bin_of(F.col("lo")), bin_of(F.col("hi")))))
    met = weak.alias("w").join(
        bins.alias("b"), (F.col("w.row") == F.col("b.row")) & (F.col("w.scope") == F.col("b.scope")) & (F.col("w.at") == F.col("b.bin")) & (F.col("w.role") != F.col("b.near_role"))
    )
    close = (F.col("last") >= F.col("lo")) & (F.col("first") <= F.col("hi"))
    roles = F.collect_set("near_role")
    near = met.filter(close).groupBy("w.row", "w.start", "w.kind", "w.end", "w.role").agg(roles.alias("roles"))
    has = lambda r: F.array_contains("roles", r)
    enough = (
        F.when(F.col("kind") == 3, has("identifier") | has("endpoint"))
        .when(F.col("kind") == 4, has("secret"))
        .otherwise(has("secret") & has("identifier"))
    )
    return near.filter(enough).select("row", "start", "kind", "end", "roles")


def scan(docs: DataFrame, reach: int = 256) -> DataFrame:
    """One row for every row of ``docs``: doc_id, n_assign, n_access, n_hex,
    base_sha256, spans (base and linked weak ones), n_linked."""
    scanned = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, SCAN), "secrets")  # texts are read once
    span = F.struct("start", "kind", F.concat_ws(":", F.element_at(F.array(*(F.lit(k) for k in KINDS)), F.col("kind") + 1), "start", "end").alias("said"))
    linked = linked_parts(scanned, reach).groupBy("row").agg(F.sort_array(F.collect_set(span)).alias("more"))
    base = F.transform(
        F.filter(F.split("base", ","), lambda x: x != ""),
        lambda x: F.struct(F.split(x, ":")[1].cast("long").alias("start"), (F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.split(x, ":")[0]) - 1).cast("int").alias("kind"), x.alias("said")),
    )
    everything = F.array_join(F.transform(F.array_sort(F.concat(base, F.col("more"))), lambda x: x["said"]), ",")
    return scanned.drop("parts").join(linked, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.when(F.col("more").isNull(), F.col("base")).otherwise(everything).alias("spans"),
        F.when(F.col("more").isNull(), 0).otherwise(F.size("more")).cast("long").alias("n_linked"),
    )
