"""Secret scan with linking of multipart credentials. DataFrame functions only.

Strong parts (base kinds) are reported wherever they occur. Weak parts are too common to report by
themselves: they are reported only if a complementary part lies within ``SCOPE`` characters of them
in the same document. That is an interval join: parts and candidates meet in cells of ``SCOPE``
characters (a candidate also looks into the cell on either side), and a semi-join keeps a candidate
once, however many partners it has.

| weak kind | what it is | complementary parts |
| --- | --- | --- |
| key | run of 30 or more characters with a digit and both cases | access, login, endpoint |
| login | assigned user, account or client id | assign, hex, key |
| endpoint | URL, or assigned host | assign, access, hex, key |

Spans are found with one ``split`` and one ``regexp_extract_all`` per kind and only in texts that
contain the kind; a running sum over the pieces gives positions in code points.

Null texts are empty; repeated rows are scanned each for themselves; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.llm.common import numbered, prepare, saved

# The patterns of the base kinds and the least length of a match (of its value).
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
BASE = (
    ("assign", ASSIGN, 12),
    ("access", r"AKIA[A-Z0-9]+", 18),
    ("hex", r"[0-9a-f]+", 16),
)
# The same matches with the least length inside the pattern where that changes nothing.
FIND = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
WEAK = (
    ("key", r"[A-Za-z0-9+/_-]{30,}"),
    ("login", r"""(?i:(?:user(?:name)?|login|account|client_?id))["']?\x20*[:=]\x20*["']?"""
              r"""[A-Za-z0-9@._+-]{3,}"""),
    ("endpoint", r"""(?i:(?:https?|postgres(?:ql)?|mysql|redis|mongodb|amqp|s3))://[^\x00-\x20"'<>]+"""
                 r"""|(?i:(?:host|endpoint|server))["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:-]{4,}"""),
)
COMPLEMENTS = {
    "key": ("access", "login", "endpoint"),
    "login": ("assign", "hex", "key"),
    "endpoint": ("assign", "access", "hex", "key"),
}
KINDS = tuple(name for name, *_ in BASE + WEAK)
SCOPE = 300


def _found(kind: str, pattern: str) -> Column:
    """Matches of one kind in order, each with the length of the text before it since the last."""
    text = F.col("text")
    pieces = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), F.length(gap).cast("long").alias("gap"),
            match.alias("match")),
    )
    return F.when(text.rlike(pattern), F.filter(pieces, lambda p: p["match"].isNotNull()))


def parts(rows: DataFrame) -> DataFrame:
    """``rid``, ``kind`` (its number), ``start`` and ``end`` of all parts, for stored ``found``."""
    each = rows.where(F.size("found") > 0).select("rid", F.posexplode("found").alias("at", "part"))
    upto = Window.partitionBy("rid", "part.kind").orderBy("at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("part.gap") + F.length("part.match")).over(upto)
    length = F.length("part.match")
    placed = each.select(
        "rid", F.col("part.kind").alias("kind"), F.col("part.match").alias("match"),
        (end - length).alias("start"), end.alias("end"))
    value = F.when(F.col("kind") == 0, F.length(F.regexp_extract("match", ASSIGN, 2))).otherwise(
        F.length("match"))
    least = F.element_at(
        F.array(*[F.lit(n) for *_, n in BASE], *[F.lit(0) for _ in WEAK]), F.col("kind") + 1)
    mixed = F.col("match").rlike("[0-9]") & F.col("match").rlike("[A-Z]") & F.col("match").rlike("[a-z]")
    return placed.where(
        (value >= least) & ((F.col("kind") != KINDS.index("key")) | mixed)).drop("match")


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts with a complementary part within ``scope`` characters; ``spans`` are stored."""
    wanted = F.create_map(*[
        x for kind, others in COMPLEMENTS.items()
        for x in (F.lit(KINDS.index(kind)), F.array(*[F.lit(KINDS.index(o)) for o in others]))])
    cells = lambda low, high: F.explode(F.sequence(
        F.floor(low / scope).cast("long"), F.floor(high / scope).cast("long")))
    partner = spans.select(
        "rid", F.col("kind").alias("other"), F.col("start").alias("from"), F.col("end").alias("to"),
        cells(F.col("start"), F.col("end")).alias("cell"))
    weak = spans.where(F.col("kind") >= len(BASE)).select(
        "rid", "kind", "start", "end", F.explode(wanted[F.col("kind")]).alias("other"),
        ).select("*", cells(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") + scope)
                 .alias("cell"))
    near = weak.join(
        partner,
        (weak["rid"] == partner["rid"]) & (weak["cell"] == partner["cell"])
        & (weak["other"] == partner["other"])
        & (partner["from"] <= weak["end"] + scope) & (weak["start"] <= partner["to"] + scope),
        "left_semi")
    return near.select("rid", "kind", "start", "end").distinct()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE
         ) -> DataFrame:
    """Per document: ``spans``, an array of (start, kind, end, name) in order of start and kind."""
    prepare(docs.sparkSession)
    patterns = FIND | dict(WEAK)
    none = F.array().cast("array<struct<kind:int,gap:bigint,match:string>>")
    rows = numbered(docs, doc_id=id_col, text=text_col).withColumn(
        "text", F.coalesce("text", F.lit("")))
    stored = saved(rows.select(
        "rid", "doc_id",
        F.concat(*[F.coalesce(_found(kind, patterns[kind]), none) for kind in KINDS]).alias("found"),
    ))
    spans = saved(parts(stored))
    reported = spans.where(F.col("kind") < len(BASE)).unionByName(linked(spans, scope))
    names = F.array(*[F.lit(k) for k in KINDS])
    by_doc = reported.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct(
        "start", "kind", "end", F.element_at(names, F.col("kind") + 1).alias("name")))).alias("spans"))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,name:string>>")
    return stored.select("rid", "doc_id").join(by_doc, "rid", "left").select(
        "doc_id", F.coalesce("spans", empty).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])),
                        ",")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans as text."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["name"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return scanned.select(
        "doc_id", *[count(name).alias(f"n_{name}") for name, *_ in BASE],
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def oracle() -> str:
    """The same in DuckDB's SQL."""
    quoted = {k: p.replace("'", "''") for k, p in (FIND | dict(WEAK)).items()}
    found = " UNION ALL ".join(
        f"SELECT r, {i} AS kind, string_split_regex(t, '{quoted[k]}') AS g, "
        f"regexp_extract_all(t, '{quoted[k]}', 0) AS m FROM d" for i, k in enumerate(KINDS))
    pairs = ", ".join(f"({KINDS.index(k)}, {KINDS.index(o)})" for k, os in COMPLEMENTS.items() for o in os)
    names = ", ".join(f"'{k}'" for k in KINDS)
    weak = len(BASE)
    text = "string_agg([" + names + "][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({found}),
u AS (SELECT r, kind, unnest(g[1:len(m)]) AS gap, unnest(m) AS match, unnest(range(len(m))) AS n
      FROM f WHERE len(m) > 0),
p AS (SELECT r, kind, match, (sum(length(gap) + length(match))
        OVER (PARTITION BY r, kind ORDER BY n))::BIGINT AS e FROM u),
s AS (SELECT r, kind, e - length(match) AS s, e FROM p WHERE CASE kind
        WHEN 0 THEN length(regexp_extract(match, '{quoted['assign']}', 2)) >= 12
        WHEN 1 THEN length(match) >= 18 WHEN 2 THEN length(match) >= 16
        WHEN 3 THEN regexp_matches(match, '[0-9]') AND regexp_matches(match, '[A-Z]')
                    AND regexp_matches(match, '[a-z]') ELSE true END),
a AS (SELECT * FROM s WHERE kind < {weak} UNION ALL
      SELECT * FROM s AS w WHERE kind >= {weak} AND EXISTS (
        SELECT 1 FROM s AS o WHERE o.r = w.r AND (w.kind, o.kind) IN ({pairs})
          AND o.s <= w.e + {SCOPE} AND w.s <= o.e + {SCOPE})),
b AS (SELECT r, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1,
        count(*) FILTER (kind = 2) AS n2, {text} FILTER (kind < {weak}) AS base, {text} AS spans
      FROM a GROUP BY r)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN b USING (r)
"""
