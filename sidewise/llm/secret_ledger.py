"""Secret scans over a ledger of blobs.

Every version of every path is addressed by the digest of its content.  A pair of
blob and rule version is scanned once, ever; findings are joined back to all paths
that hold the blob.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import on_arrow, same, sha256_bytes, stored, texts


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds spans; those whose ``group`` is shorter than ``least`` are dropped.

    ``folded`` matches against the text with A-Z lower-cased.  ``hints``: a text
    without any of these strings can't match.  ``passes`` decides on a match by more than its form.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    folded: bool = False
    hints: tuple[str, ...] = field(default=())
    passes: Callable[[re.Match], bool] | None = None

    def spans(self, text: str, folded: str) -> list[tuple[int, int]]:
        if self.folded:
            text = folded
        if self.hints and not any(hint in text for hint in self.hints):
            return []
        group, least, passes = self.group, self.least, self.passes
        found = (m for m in re.finditer(self.pattern, text) if m.end(group) - m.start(group) >= least)
        return [m.span() for m in found if passes is None or passes(m)]


# Digits of the checksum at the end of a token, its length.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
CHECKSUM = 6
#: Bits a character that a quoted string needs to count as random; plain words and numbers stay below.
RANDOM_BITS = 4.0


def base62(number: int) -> str:
    digits = ""
    for _ in range(CHECKSUM):
        number, digit = divmod(number, len(BASE62))
        digits = BASE62[digit] + digits
    return digits


def checksum_holds(m: re.Match) -> bool:
    """Whether a token ends in the checksum of its random part."""
    return base62(zlib.crc32(m[1].encode())) == m[2]


def looks_random(m: re.Match) -> bool:
    """Whether a quoted string mixes digits and both cases, with at least ``RANDOM_BITS`` of entropy a character."""
    body = m[1]
    if not all(re.search(kind, body) for kind in ("[0-9]", "[a-z]", "[A-Z]")):
        return False
    shares = [n / len(body) for n in Counter(body).values()]
    return -sum(p * math.log2(p) for p in shares) >= RANDOM_BITS


# Runs of "hex" and "access" are maximal, so asking for the length inside the pattern
# drops the same matches as asking afterwards.  A failing "assign" uses up its text.
RULES = (
    Rule(
        "assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, least=8, folded=True, hints=("passw", "secret", "token", "api_key", "apikey"),
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", hints=("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)

# Found beside the base rules, whose spans they never change.
ADDED = (
    Rule(
        "key_block", 1, r"-----BEGIN ((?:[A-Z0-9]+ )*)PRIVATE KEY-----[A-Za-z0-9+/=,:\s-]*?-----END \1PRIVATE KEY-----",
        hints=("PRIVATE KEY-----",),
    ),
    Rule("checked", 1, r"gh[oprsu]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])", hints=("gho_", "ghp_", "ghr_", "ghs_", "ghu_"), passes=checksum_holds),
    Rule("random", 1, r"""["']([A-Za-z0-9+/_=-]{24,})["']""", hints=('"', "'"), passes=looks_random),
)

LEDGER = "blob binary, kind string, version int, spans array<struct<start:int,end:int>>"


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


@on_arrow(pa.binary())
def packed(text: pa.Array) -> pa.Array:
    """Texts deflated one by one, for a shuffle."""
    return pa.array([zlib.compress(content.encode()) for content in text.to_pylist()], pa.binary())


def _scanner(rules: tuple[Rule, ...]):
    by_kind = {rule.kind: rule for rule in rules}
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("version", pa.int32()), ("spans", pa.list_(span))]))

    @on_arrow(kind)
    def scan_text(text: pa.Array, kinds: pa.Array) -> pa.Array:
        out = []
        for deflated, wanted in zip(text.to_pylist(), kinds.to_pylist()):
            content = zlib.decompress(deflated).decode()
            folded = content.encode().lower().decode()  # A-Z only, so offsets stay
            out.append(
                [
                    {"kind": k, "version": by_kind[k].version, "spans": [{"start": a, "end": b} for a, b in by_kind[k].spans(content, folded)]}
                    for k in wanted
                ]
            )
        return pa.array(out, kind)

    return scan_text


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES + ADDED) -> tuple[DataFrame, DataFrame]:
    """(ledger with the new entries, one row per version: doc_id, blob, findings).

    ``versions`` has ``doc_id`` (the path) and ``text``; a path may have any number of
    versions, each gives a row, repeated rows included.  Null texts are the empty blob,
    null paths are paths; other columns are left out.  ``findings`` holds a
    struct of kind, version and spans per rule.
    """
    c = F.col
    ledger = empty(versions.sparkSession) if ledger is None else ledger
    rows = texts(versions).select("doc_id", sha256_bytes(c("text")).alias("blob"), "text")
    paths = stored(rows.drop("text"), "versions")
    # One path speaks for a blob, however many hold it.
    blobs = paths.groupBy("blob").agg(F.min("doc_id").alias("speaker"))
    pairs = blobs.select("*", F.explode(F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])).alias("rule"))
    pairs = pairs.select("blob", "speaker", "rule.kind", "rule.version")
    unseen = pairs.join(ledger, ["blob", "kind", "version"], "left_anti")
    unseen = unseen.groupBy("blob", "speaker").agg(F.sort_array(F.collect_list("kind")).alias("kinds"))
    wanted = unseen.select(c("blob").alias("w_blob"), "speaker", "kinds").hint("shuffle_hash")
    content = rows.select("doc_id", "blob", packed(c("text")).alias("text")).join(wanted, (c("blob") == c("w_blob")) & same(c("doc_id"), c("speaker")))
    scanned = content.select("blob", F.explode(_scanner(rules)("text", "kinds")).alias("found")).select("blob", "found.*")
    # A path may repeat the blob it speaks for.
    fresh = stored(scanned.dropDuplicates(["blob", "kind", "version"]), "ledger")
    ledger = ledger.unionByName(fresh)
    current = F.lit(False)
    for rule in rules:
        current = current | ((c("kind") == rule.kind) & (c("version") == rule.version))
    by_blob = ledger.where(current).groupBy("blob").agg(F.collect_list(F.struct("kind", "version", "spans")).alias("findings"))
    return ledger, paths.join(by_blob, "blob", "left").select("doc_id", "blob", "findings")


def report(findings: DataFrame, base: tuple[Rule, ...] = RULES, added: tuple[Rule, ...] = ADDED) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans, by start and then by the order of the rules."""
    c = F.col
    order = F.create_map(*[x for i, r in enumerate(base + added) for x in (F.lit(r.kind), F.lit(i))])
    listed = F.array_sort(
        F.flatten(
            F.transform(
                "findings",
                lambda f: F.transform(
                    f["spans"], lambda s: F.struct(s["start"].alias("start"), order[f["kind"]].alias("nth"), f["kind"].alias("kind"), s["end"].alias("end"))
                ),
            )
        )
    )

    def text(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("listed", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    rows = findings.select("doc_id", listed.alias("listed")).withColumn("base", F.filter("listed", lambda s: s["nth"] < len(base)))
    return rows.select("doc_id", *[count(r.kind) for r in base], F.sha2(text("base"), 256).alias("base_sha256"), text("listed").alias("spans"))
