r"""Secret scan: sure patterns, and weak candidates that count only where complementary parts meet.

Sure spans are `assign`, `access` and `hex`. Weak ones are a bare `secret` (40 characters as in
access keys) and an `endpoint` (a URL or service host). Parts of a document are joined by interval:
a secret is reported when an access identifier starts within `SCOPE` code points of it, an endpoint
when both an access identifier and an assigned or bare secret do.

Only DataFrame functions are used. Offsets come from splitting a text at the matches: the lengths of
the pieces and of the matches, added up. The interval join is an equality join on bins as wide as the
scope, of the first and last start of each kind in a bin: what lies within the scope of a point is in
its own bin, or is the last of the bin before or the first of the bin after. So no pairs are made,
and a document with a million parts is spread over its bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bantin.llm.common import query, stored, table, whole_text

SCOPE = 400
_MIN_VALUE, _MIN_ACCESS, _MIN_HEX = 8, 16, 32
KINDS = ["assign", "access", "hex", "secret", "endpoint"]
ASSIGN, ACCESS, HEX, SECRET, ENDPOINT = range(5)

_NAME = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
_ASSIGN = rf"""(?i){_NAME}\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]+"
_HEX = r"[0-9a-f]+"
_SECRET = r"(?<![A-Za-z0-9/+])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=])"
_URL = r"""https?://[^\s"'<>]+"""
_HOST = r"[a-z0-9.-]*[a-z0-9]\.amazonaws\.com"
# A host is looked for once in a run of its letters, from the start of the run: else long runs take quadratic time.
_ENDPOINT = rf"{_URL}|(?<![a-z0-9.-]){_HOST}"

_SPAN = "array<struct<start:int,kind:int,end:int>>"
_BLOCK = 256


def _running(values: Column) -> Column:
    """Running totals of an array. Block by block, as building an array in a fold is quadratic."""
    n = F.size(values)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")), lambda b: F.slice(values, b * _BLOCK + 1, _BLOCK))
    add = lambda array: F.aggregate(array, F.lit(0), lambda total, x: total + x)
    bases = F.aggregate(blocks, F.array(F.lit(0)), lambda done, b: F.concat(done, F.array(F.element_at(done, -1) + add(b))))
    inside = F.zip_with(
        blocks, F.slice(bases, 1, F.size(blocks)),
        lambda b, base: F.transform(b, lambda x, i: base + add(F.slice(b, 1, i + 1))),
    )
    return F.flatten(inside)


def _bind(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _spans(text: Column, guard: Column, pattern: str, kind: int, keep=None, measure: Column | None = None) -> Column:
    """Spans of all matches, in code points, for texts that pass the guard; `keep` tests a match's measured length."""
    matches = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    gaps = F.transform(F.split(text, pattern, -1), F.length)

    def located(parts: Column) -> Column:
        steps = F.transform(parts["m"], lambda m, i: m + F.get(parts["g"], i))
        spans = F.zip_with(_running(steps), parts["m"], lambda end, m: F.struct((end - m).alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        if keep is not None:
            spans = F.filter(spans, lambda s, i: keep(s["end"] - s["start"], F.get(parts["v"], i)))
        return F.when(F.size(parts["m"]) > 0, spans)

    value = matches if measure is None else F.transform(measure, F.length)
    found = _bind(F.struct(matches.alias("m"), gaps.alias("g"), value.alias("v")), located)
    return F.coalesce(F.when(guard, found), F.array()).cast(_SPAN)


def find_parts(docs: DataFrame) -> DataFrame:
    """One row per document: `key`, doc_id, `sure` and `weak` spans. Null texts are empty; nothing is left out."""
    text = F.col("_text")
    rows = docs.select(F.col("doc_id"), whole_text().alias("_text"))
    assigned = _spans(text, text.rlike("(?i)" + _NAME), _ASSIGN, ASSIGN, lambda n, v: v >= _MIN_VALUE, F.regexp_extract_all(text, F.lit(_ASSIGN), F.lit(2)))
    has_access = text.contains("AKIA")
    access = _spans(text, has_access, _ACCESS, ACCESS, lambda n, v: n >= _MIN_ACCESS)
    # Runs too short to count match nothing here, and leave the others where they are.
    long_hex = _spans(text, text.rlike("[0-9a-f]{%d}" % _MIN_HEX), _HEX.replace("+", "{%d,}+" % _MIN_HEX), HEX)
    # Weak parts need an access identifier near them, so other texts need no search.
    secret = _spans(text, has_access, _SECRET, SECRET)
    endpoint = _spans(text, has_access & (text.contains("://") | text.contains("amazonaws")), _ENDPOINT, ENDPOINT)
    return rows.select(
        F.monotonically_increasing_id().alias("key"), "doc_id",
        F.concat(assigned, access, long_hex).alias("sure"), F.concat(secret, endpoint).alias("weak"),
    )


def _linked(found: DataFrame, scope: int) -> DataFrame:
    """key and `more`: the weak spans that have their complements within the scope."""
    parts = found.select("key", F.explode(F.concat("sure", "weak")).alias("s")).where(F.col("s.kind") != HEX)
    role = F.when(F.col("s.kind") == ACCESS, 0).otherwise(1)
    binned = parts.withColumn("bin", F.floor(F.col("s.start") / scope).cast("int"))
    ends = binned.where(F.col("s.kind") != ENDPOINT).groupBy("key", "bin", role.alias("role")).agg(
        F.min("s.start").alias("first"), F.max("s.start").alias("last")
    )
    # What a bin tells itself and its neighbours; a candidate meets at most one row.
    told = ends.select(
        "key", "role", "first", "last", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"), F.col("bin").alias("own")
    )
    def pick(role_id: int, side: str) -> Column:
        here = {"before": F.col("own") < F.col("bin"), "here": F.col("own") == F.col("bin"), "after": F.col("own") > F.col("bin")}[side]
        value = F.when((F.col("role") == role_id) & here, F.col("last" if side == "before" else "first"))
        return F.max(value).alias(f"{side}{role_id}")

    seen = told.groupBy("key", "bin").agg(*[pick(r, s) for r in (0, 1) for s in ("before", "here", "after")])
    start = F.col("s.start")

    def near(r: int) -> Column:
        return F.coalesce(
            F.col(f"here{r}").isNotNull() | (F.col(f"before{r}") >= start - scope) | (F.col(f"after{r}") <= start + scope), F.lit(False)
        )

    weak = binned.where(F.col("s.kind") >= SECRET).join(seen, ["key", "bin"])
    linked = weak.where(near(0) & ((F.col("s.kind") == SECRET) | near(1)))
    return linked.groupBy("key").agg(F.collect_list("s").alias("more"))


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row: doc_id, `sure` spans and `spans` (sure and linked weak ones), as (start, kind, end).

    Null and empty texts have no spans. Repeated rows and rows without a doc_id are answered each on
    its own; other columns are not looked at.
    """
    # Stored without the texts, so that keys are fixed and the texts are read once.
    found = stored(find_parts(docs))
    linked = _linked(found, scope).withColumnRenamed("key", "linked_key")
    joined = found.join(linked, F.col("key") == F.col("linked_key"), "left")
    return joined.select("doc_id", "sure", F.concat("sure", F.coalesce("more", F.array().cast(_SPAN))).alias("spans"))


def _either_case(pattern: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in pattern)


def _sql_spans(kind: int, pattern: str, least: str) -> str:
    """Matches by position: list lengths of gaps and matches, added up."""
    return f"""SELECT doc_id, {kind} AS kind, CAST(e - m[i] AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM (
      SELECT doc_id, m, v, i, list_sum(m[1:i]) + list_sum(g[1:i]) AS e FROM (
        SELECT doc_id, m, v, g, unnest(range(1, len(m) + 1)) AS i FROM (
          SELECT doc_id, list_transform(regexp_extract_all(t, '{pattern}', 0), lambda x: length(x)) AS m,
            list_transform(regexp_extract_all(t, '{pattern}', {2 if kind == ASSIGN else 0}), lambda x: length(x)) AS v,
            list_transform(string_split_regex(t, '{pattern}'), lambda x: length(x)) AS g FROM t))) WHERE {least}"""


_SQL_ASSIGN = (
    f"({'|'.join(map(_either_case, ('password', 'passwd', 'secret', 'token', 'api_?key')))})"
    r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
# The pattern engine of the twin has no look-around: a whole run of exactly 40 such characters and no '=' is the same.
_SQL_SECRET = r"[A-Za-z0-9/+]+=?"
_SQL_ENDPOINT = f"{_URL}|{_HOST}".replace("'", "''")
SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
sure AS ({_sql_spans(ASSIGN, _SQL_ASSIGN, f"v[i] >= {_MIN_VALUE}")}
  UNION ALL {_sql_spans(ACCESS, _ACCESS, f"m[i] >= {_MIN_ACCESS}")}
  UNION ALL {_sql_spans(HEX, _HEX, f"m[i] >= {_MIN_HEX}")}),
weak AS (SELECT doc_id, kind, s, e FROM (SELECT x.*, substring(t.t, s + 1, e - s) AS w FROM ({_sql_spans(SECRET, _SQL_SECRET, "m[i] = 40")}) x JOIN t USING (doc_id)) WHERE NOT contains(w, '=')
  UNION ALL {_sql_spans(ENDPOINT, _SQL_ENDPOINT, "true")}),
parts AS (SELECT * FROM sure UNION ALL SELECT * FROM weak),
linked AS (SELECT * FROM weak WHERE EXISTS (SELECT 1 FROM parts p WHERE p.doc_id = weak.doc_id AND p.kind = {ACCESS} AND abs(p.s - weak.s) <= {SCOPE})
  AND (kind = {SECRET} OR EXISTS (SELECT 1 FROM parts p WHERE p.doc_id = weak.doc_id AND p.kind IN ({ASSIGN}, {SECRET}) AND abs(p.s - weak.s) <= {SCOPE}))),
shown AS (SELECT doc_id, kind, s, ['assign', 'access', 'hex', 'secret', 'endpoint'][kind + 1] || ':' || s || ':' || e AS x, kind <= {HEX} AS base
  FROM (SELECT * FROM sure UNION ALL SELECT * FROM linked))
SELECT t.doc_id, count(*) FILTER (kind = {ASSIGN}) AS n_assign, count(*) FILTER (kind = {ACCESS}) AS n_access, count(*) FILTER (kind = {HEX}) AS n_hex,
  sha256(coalesce(string_agg(x, ',' ORDER BY s, kind) FILTER (base), '')) AS base_sha256, coalesce(string_agg(x, ',' ORDER BY s, kind), '') AS spans
FROM t LEFT JOIN shown ON shown.doc_id = t.doc_id GROUP BY t.doc_id
"""


@query(SQL)
def op8_secret_scan(spark, sf_dir):
    """Every document's secrets."""
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("sure", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select(
        "doc_id", count(ASSIGN), count(ACCESS), count(HEX),
        F.sha2(_listed(F.col("sure")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )
