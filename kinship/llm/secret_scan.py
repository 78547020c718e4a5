"""Secret scan with corpus-wide ownership frequency.

Spans are found in every whole text. The value of each span is hashed, and
the hashes are counted over the corpus by distinct repositories and distinct
owners. A value that many owners hold is a copied example (documentation, a
test fixture); a value that stays with few owners and looks random is taken
for a live credential of theirs.

Defined results: a null text counts as empty and has no spans; rows are never
merged, so repeated rows and repeated ids each give their row; a null
repository or owner counts as one further repository or owner; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.llm.common import numbered, written

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")

# The kinds beside the base ones: name, a literal without which nothing can
# match, the pattern (group 1, if any, is the secret value).
FURTHER = (
    ("github", "gh", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}")),
    ("slack", "xox", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
    ("google", "AIza", re.compile(r"\bAIza[A-Za-z0-9_-]{35}")),
    ("stripe", "k_live_", re.compile(r"\b[sr]k_live_[A-Za-z0-9]{16,}")),
    ("jwt", "eyJ", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("pem", "PRIVATE KEY", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]|-(?!----END))*-----END [A-Z ]*PRIVATE KEY-----")),
    ("bearer", "earer ", re.compile(r"\b[Bb]earer ([A-Za-z0-9._~+/-]{20,}=*)")),
)
# A credential in a URL, of any length: around each "://" the scheme before it
# and the user and password after it. None of them can hold a "://", so no
# character is read more than a few times.
LOGIN = re.compile(r"://[^\s:/@]+:([^\s:/@]{3,})@")
NO_SCHEME = re.compile(r"[^A-Za-z0-9+.-]")
SCHEME = re.compile(r"\b[A-Za-z]")

BASE = ("assign", "access", "hex")
KINDS = (*BASE, *(name for name, _, _ in FURTHER[:-1]), "url", FURTHER[-1][0])
ORDER = {kind: i for i, kind in enumerate(KINDS)}

SPAN = "struct<kind:string,start:int,end:int,value_start:int,value_end:int,hash:string,entropy:double>"


def entropy(value: str) -> float:
    """Bits a character, from the value's own character counts."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def logins(text: str) -> Iterator[tuple[str, int, int, int, int]]:
    """The spans of kind url; the value leaves out the "@" that ends the span."""
    done = 0
    for m in LOGIN.finditer(text):
        at = m.start()
        while at > done and not NO_SCHEME.match(text, at - 1):
            at -= 1
        if scheme := SCHEME.search(text, at, m.start()):
            yield "url", scheme.start(), m.end(), m.start(1), m.end(1)
        done = m.end()


def spans(text: str) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, start and end of the value) in code points, by start, then kind."""
    out = []
    if "=" in text or ":" in text:
        out += [("assign", m.start(), m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [("hex", m.start(), m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    for kind, literal, pattern in FURTHER:
        if literal in text:
            out += [(kind, *m.span(), *m.span(pattern.groups)) for m in pattern.finditer(text)]
    out += logins(text)
    return sorted(out, key=lambda s: (s[1], ORDER[s[0]]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for text in batch.column("_text").to_pylist():
            found.append(
                [
                    {
                        "kind": kind,
                        "start": start,
                        "end": end,
                        "value_start": at,
                        "value_end": to,
                        "hash": hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest(),
                        "entropy": entropy(value),
                    }
                    for kind, start, end, at, to in spans(text)
                    for value in (text[at:to],)
                ]
            )
        kept = batch.drop_columns(["_text"])
        column = pa.array(
            found,
            pa.list_(
                pa.struct(
                    [
                        ("kind", pa.string()),
                        ("start", pa.int32()),
                        ("end", pa.int32()),
                        ("value_start", pa.int32()),
                        ("value_end", pa.int32()),
                        ("hash", pa.string()),
                        ("entropy", pa.float64()),
                    ]
                )
            ),
        )
        yield pa.RecordBatch.from_arrays([*kept.columns, column], names=[*kept.schema.names, "spans"])


def find_spans(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, repository, owner, spans (array, by start)."""
    rows = docs.select(
        F.col("doc_id"),
        F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_find, f"doc_id {kind}, repository string, owner string, spans array<{SPAN}>")


def ownership(found: DataFrame) -> DataFrame:
    """Counts of each hash over the corpus: n_repositories, n_owners.

    The two distinct counts are partial aggregates by (hash, repository) and
    (hash, owner), so a value in a third of all documents is counted where it
    is read before anything moves.
    """
    values = found.select(
        F.coalesce("repository", F.lit("\0")).alias("repository"),
        F.coalesce("owner", F.lit("\0")).alias("owner"),
        F.explode(F.array_distinct(F.col("spans.hash"))).alias("hash"),
    )
    owners = (
        values.groupBy("hash", "owner")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n_owners"))
    )
    repositories = (
        values.groupBy("hash", "repository")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n_repositories"))
    )
    return repositories.join(owners, "hash")


def scan(
    docs: DataFrame,
    repository: str = "doc_id",
    owner: str = "source",
    copied_owners: int = 3,
    copied_repositories: int = 20,
    live_entropy: float = 2.5,
) -> DataFrame:
    """One row per document row: doc_id and ``spans``, each with its verdict.

    ``spans`` is array<struct<kind, start, end, value_start, value_end, hash, entropy,
    n_repositories, n_owners, verdict>>, by start and kind. The verdict is
    ``copied`` where at least ``copied_owners`` owners hold the value, or one or
    two owners in at least ``copied_repositories`` repositories, else
    ``live`` where its entropy is at least ``live_entropy`` bits a character,
    else ``weak``.
    """
    found = written(numbered(find_spans(docs, repository, owner), "row"), "secret-spans")
    some = found.where(F.size("spans") > 0)
    counted = ownership(some)
    one = F.col("span")
    verdict = (
        F.when((F.col("n_owners") >= copied_owners) | (F.col("n_repositories") >= copied_repositories), "copied")
        .when(one["entropy"] >= live_entropy, "live")
        .otherwise("weak")
    )
    judged = (
        some.select("row", F.posexplode("spans").alias("place", "span"))
        .withColumn("hash", one["hash"])
        .join(counted, "hash")
        .groupBy("row")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "place",
                        one["kind"].alias("kind"),
                        one["start"].alias("start"),
                        one["end"].alias("end"),
                        one["value_start"].alias("value_start"),
                        one["value_end"].alias("value_end"),
                        "hash",
                        one["entropy"].alias("entropy"),
                        "n_repositories",
                        "n_owners",
                        verdict.alias("verdict"),
                    )
                )
            ).alias("judged")
        )
    )
    bare = F.transform("judged", lambda s: s.dropFields("place"))
    none = F.array().cast(
        "array<struct<kind:string,start:int,end:int,value_start:int,value_end:int,hash:string,entropy:double,"
        "n_repositories:bigint,n_owners:bigint,verdict:string>>"
    )
    return found.join(judged, "row", "left").select("doc_id", F.coalesce(bare, none).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """Columns of the registered query, from the spans of :func:`scan`."""
    spans_of = F.col("spans")

    def joined(chosen):
        return F.array_join(
            F.transform(
                chosen,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    def count(kind):
        return F.size(F.filter(spans_of, lambda s: s["kind"] == kind)).cast("long")

    base = F.filter(spans_of, lambda s: s["kind"].isin(*BASE))
    return scanned.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans_of).alias("spans"),
        joined(F.filter(spans_of, lambda s: s["verdict"] == "live")).alias("live_spans"),
        joined(F.filter(spans_of, lambda s: s["verdict"] == "copied")).alias("copied_spans"),
    )


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        i = batch.schema.get_field_index("text")
        cuts, mark = batch.column("_kn_cuts").to_pylist(), batch.column("_kn_mark").to_pylist()
        out = []
        for text, places, put in zip(batch.column(i).to_pylist(), cuts, mark, strict=True):
            out.append(text if text is None or not places else cut(text, places, put))
        columns = [*batch.columns]
        columns[i] = pa.array(out, pa.string())
        whole = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
        yield whole.drop_columns(["_kn_cuts", "_kn_mark"])


def cut(text: str, places: list[dict], mark: str) -> str:
    """``text`` with each of the places replaced; places that overlap become one mark."""
    pieces, at = [], 0
    for start, end in sorted((p["start"], p["end"]) for p in places):
        if start >= at:
            pieces += [text[at:start], mark]
        at = max(at, end)
    return "".join(pieces) + text[at:]


def redact(docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with the value of each live span replaced by ``mark``; same columns, all rows.

    The found places are joined back by id and a hash of the text, so rows
    that repeat an id get their own places.
    """
    text_hash = F.xxhash64("text")
    source = docs.select(
        F.struct(F.col("doc_id").alias("id"), text_hash.alias("h")).alias("doc_id"),
        F.col("doc_id").alias("repository"),
        "source",
        "text",
    )
    live = F.filter("spans", lambda s: s["verdict"] == "live")
    cuts = written(
        scan(source, repository="repository", **options)
        .select(
            F.col("doc_id.id").alias("_kn_id"),
            F.col("doc_id.h").alias("_kn_h"),
            F.transform(live, lambda s: F.struct(s["value_start"].alias("start"), s["value_end"].alias("end"))).alias("_kn_cuts"),
        )
        .where(F.size("_kn_cuts") > 0)
        .groupBy("_kn_id", "_kn_h")
        .agg(F.first("_kn_cuts").alias("_kn_cuts")),
        "secret-cuts",
    )
    same = F.col("doc_id").eqNullSafe(F.col("_kn_id")) & (F.col("_kn_text") == F.col("_kn_h"))
    joined = docs.withColumn("_kn_text", text_hash).join(cuts, same, "left")
    kept = joined.select(*(F.col(c) for c in docs.columns), "_kn_cuts", F.lit(mark).alias("_kn_mark"))
    return kept.mapInArrow(_redact, docs.schema)
