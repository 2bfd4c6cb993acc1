"""Secret scans with multipart credential linking (DataFrame operations only).

Strong spans are reported always: ``assign`` (a named value), ``access`` (an
access identifier), ``hex`` (a long hexadecimal run).  Weak candidates -
``user`` (an account name), ``opaque`` (a long mixed token), ``url`` (an
endpoint) - are common in harmless text, so they are reported only where the
parts that complete them lie within ``scope`` code points: a user needs a
secret, an opaque token needs an identifier or an endpoint, an endpoint needs
both an identifier and a secret.  A weak candidate that overlaps a strong span
adds nothing and is dropped.

The interval join is a sweep: candidates of a document sorted by place, with
the nearest part of each role before and after as running extremes, so no
pairs are made.  Only candidates are shuffled (a few bytes for each), never
the texts; a task holds the candidates of one document at a time.

Defined cases: null text is empty; empty texts have no spans; very long texts
are searched whole, one at a time; spans that begin at one place come in the order of
``KINDS``; rows that repeat keep one result each; null doc_id is an id like
another; an empty table gives no rows; other columns, whatever their names, are
ignored by ``scan`` and kept by ``redact``.
Places are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialise

SCOPE = 200
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind -> (role, weak, pattern, group whose length counts, least length), in the order in which spans at one place are listed.
KINDS: dict[str, tuple[str, bool, str, int, int]] = {
    "assign": ("secret", False, ASSIGN, 2, 6),
    "access": ("id", False, r"AKIA[A-Z0-9]+", 0, 20),
    "hex": ("secret", False, r"[0-9a-f]+", 0, 24),
    "user": ("id", True, r"""(?i:user_?name|user_?id|client_?id|account|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]+)""", 1, 3),
    "opaque": ("secret", True, r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{32,}", 0, 32),
    "url": ("endpoint", True, r"""(?i:https?|jdbc|postgres|mysql|mongodb|redis|amqp|ftp)(?::[a-z]+)?://[^\x20\x09-\x0D"'<>]+""", 0, 10),
}
#: Runs that a scan would visit one by one although they are too short to count.
_SEARCH = {"hex": r"[0-9a-f]{24,}"}
_RANK = {k: i for i, k in enumerate(KINDS)}


def _of_kind(text: Column, kind: str) -> Column:
    _, _, pattern, group, least = KINDS[kind]
    pattern = _SEARCH.get(kind, pattern)
    rank, p = F.lit(_RANK[kind]), F.lit(pattern)
    whole = F.transform(F.regexp_extract_all(text, p, F.lit(0)), lambda h: F.length(h))
    part = F.transform(F.regexp_extract_all(text, p, F.lit(group)), lambda h: F.length(h)) if group else whole
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    each = F.filter(F.arrays_zip(whole.alias("n"), part.alias("part"), gaps.alias("gap")), lambda x: x["n"].isNotNull())
    rows = F.transform(
        each,
        lambda x, i: F.struct(
            rank.alias("kind"), i.alias("nth"), x["gap"].alias("gap"), x["n"].alias("n"), (x["part"] >= least).alias("ok")
        ),
    )
    return F.when(F.regexp_like(text, p), rows)


def _candidates(text: Column) -> Column:
    """Array of (kind, nth of its kind, characters before it since the last, length, counts)."""
    empty = F.expr("CAST(array() AS array<struct<kind:int,nth:int,gap:int,n:int,ok:boolean>>)")
    return F.concat(*[F.coalesce(_of_kind(text, kind), empty) for kind in KINDS])


def _spans(keyed: DataFrame, payload: str | None, scope: int) -> DataFrame:
    """keyed: key, candidates, and payload if named.  One row per row of keyed: key, spans, payload."""
    rows = keyed.select("key", *([payload] if payload else []), F.posexplode_outer("candidates").alias("at", "c"))
    rows = rows.select(
        "key",
        F.coalesce("at", F.lit(0)).alias("at"),
        *([F.when(F.coalesce("at", F.lit(0)) == 0, F.col(payload)).alias(payload)] if payload else []),
        "c.*",
    )
    rows = rows.repartition("key")
    along = Window.partitionBy("key", "kind", "copy").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    # rows that repeat come as copies: the nth row of each place belongs to the nth copy
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("key", "at").orderBy("kind")))
    rows = rows.withColumn("stop", F.sum(F.col("gap").cast("long") + F.col("n")).over(along))
    rows = rows.withColumn("start", F.col("stop") - F.col("n"))
    role = F.element_at(F.array(*[F.lit(r) for r, *_ in KINDS.values()]), F.col("kind") + 1)
    weak = F.element_at(F.array(*[F.lit(w) for _, w, *_ in KINDS.values()]), F.col("kind") + 1)
    rows = rows.withColumns({"role": F.when(F.col("ok"), role), "weak": weak})
    before = Window.partitionBy("key", "copy").orderBy("start", "stop", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = (
        Window.partitionBy("key", "copy")
        .orderBy(F.desc("start"), F.desc("stop"), F.desc("kind"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    near = {}
    for r in ("id", "secret", "endpoint"):
        this = F.col("role") == r
        near[r] = F.coalesce(F.col("start") - F.max(F.when(this, F.col("stop"))).over(before) <= scope, F.lit(False)) | F.coalesce(
            F.min(F.when(this, F.col("start"))).over(after) - F.col("stop") <= scope, F.lit(False)
        )
    strong = F.col("ok") & ~F.col("weak")
    covered = F.coalesce(F.max(F.when(strong, F.col("stop"))).over(before) > F.col("start"), F.lit(False)) | F.coalesce(
        F.min(F.when(strong, F.col("start"))).over(after) < F.col("stop"), F.lit(False)
    )
    rows = rows.withColumns({f"near_{r}": c for r, c in near.items()} | {"covered": covered})
    linked = F.expr(
        "CASE role WHEN 'id' THEN near_secret WHEN 'secret' THEN near_id OR near_endpoint ELSE near_id AND near_secret END"
    )
    rows = rows.withColumn("report", F.col("ok") & (~F.col("weak") | (linked & ~F.col("covered"))))
    # where the reported spans before this one end: spans may nest
    reach = F.coalesce(F.max(F.when(F.col("report"), F.col("stop"))).over(before), F.lit(0))
    rows = rows.withColumn("reach", reach)
    span = F.struct("start", F.col("kind").alias("rank"), "stop", "reach")
    out = rows.groupBy("key", "copy").agg(
        F.array_sort(F.collect_list(F.when(F.col("report"), span))).alias("spans"),
        *([F.first(payload, True).alias(payload)] if payload else []),
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(
        "spans",
        lambda s: F.struct(
            F.element_at(names, s["rank"] + 1).alias("kind"), s["start"].alias("start"), s["stop"].alias("end"), s["reach"].alias("reach")
        ),
    )
    return out.withColumn("spans", spans).drop("copy")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("body", text).withColumn("key", F.struct("doc_id", F.xxhash64("body").alias("text_hash")))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id and spans, array of (kind, start, end) by place."""
    found = _keyed(docs.select("doc_id", "text")).select("key", _candidates(F.col("body")).alias("candidates"))
    spans = F.transform("spans", lambda s: s.dropFields("reach"))
    return _spans(found, None, scope).select("key.doc_id", spans.alias("spans"))


def redact(docs: DataFrame, scope: int = SCOPE, mask: str = "[SECRET]") -> DataFrame:
    """docs with every reported span replaced by ``mask`` (n_chars follows, if there).

    The texts are searched once and written beside their candidates.  Documents
    without a candidate pass untouched and unshuffled; the others carry their
    text along with the first of their candidates.
    """
    columns = docs.columns
    rows = docs.select(F.struct(*columns).alias("row"), "doc_id", "text")  # other columns can't clash in there
    found = _keyed(rows).select("key", "row", _candidates(F.col("body")).alias("candidates"))
    found = materialise(found, "candidates")
    clean = found.filter(F.size("candidates") == 0).select("row.*")
    row = found.filter(F.size("candidates") > 0).select("key", "row", "candidates")
    spans = _spans(row, "row", scope)
    pieces = F.expr(
        "transform(spans, s -> IF(s.start < s.reach, '', concat(substr(row.text, s.reach + 1, s.start - s.reach), mask)))"
    )
    out = spans.withColumn("mask", F.lit(mask)).withColumn("pieces", pieces)
    text = F.when(
        F.size("spans") > 0,
        F.concat(F.array_join("pieces", ""), F.expr("substr(row.text, array_max(transform(spans, s -> s.end)) + 1)")),
    ).otherwise(F.col("row.text"))
    fields = {c: F.col("row")[c] for c in columns} | {"text": text}
    if "n_chars" in columns:
        fields["n_chars"] = F.when(F.size("spans") > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("row.n_chars")
        )
    return clean.unionByName(out.select(*[fields[c].alias(c) for c in columns]))
