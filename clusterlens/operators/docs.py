"""Log-document operators over ``docs(idx, doc_id, ts, ...fields)``: search, terms, recent, catalogs.

Predicates are Spark Columns, SQL text, or trees of comparisons (the free-text
query languages of other engines are not rebuilt). Under ANSI mode a type
mismatch in a Column or SQL text fails the job; in a tree it does not match
(``lenient``).
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import predicates as Q
from ..functions import render as R
from .guards import attach_row, positive, top_per_group, with_status, with_total

SOURCE_FIELDS = ("idx", "doc_id", "level", "host", "event_type", "message", "value", "props")


COMPARE = {"eq": operator.eq, "lt": operator.lt, "le": operator.le, "gt": operator.gt, "ge": operator.ge}


def _literal(value, kind: T.DataType) -> Column | None:
    """``value`` as a literal of the field's type; None where it can never match. No cast of it can fail."""
    if isinstance(kind, T.StringType):
        return F.lit(str(value).lower() if isinstance(value, bool) else str(value))
    if isinstance(kind, T.BooleanType):
        text = str(value).lower()
        return F.lit(text == "true") if text in ("true", "false") else None
    if isinstance(kind, T.NumericType):
        if isinstance(value, str):
            try:
                value = int(value) if value.strip().lstrip("+-").isdecimal() else float(value)
            except ValueError:
                return None
        return F.lit(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) and isinstance(value, (str, date, datetime)):
        return F.lit(str(value)).try_cast(kind)
    return None


def _compare(field: Column, kind: T.DataType, op: str, value) -> Column:
    if isinstance(kind, T.ArrayType):  # any element
        return F.exists(field, lambda x: F.coalesce(_compare(x, kind.elementType, op, value), F.lit(False)))
    if op == "like":
        return field.rlike(Q.glob_to_regex(str(value))) if isinstance(kind, T.StringType) else F.lit(False)
    if op == "in":
        wanted = [w for w in (_literal(v, kind) for v in value) if w is not None]
        return field.isin(*wanted) if wanted else F.lit(False)
    wanted = _literal(value, kind)
    return F.lit(False) if wanted is None else COMPARE[op](field, wanted)


def _resolve(docs: DataFrame, name: str, value) -> tuple[Column, T.DataType] | None:
    """The named column, a field of a struct, or a dotted path inside a column of JSON text (typed like ``value``)."""
    head, _, rest = name.partition(".")
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    if name in kinds:
        return F.col(f"`{name}`"), kinds[name]
    kind, field = kinds.get(head), F.col(f"`{head}`")
    while rest and isinstance(kind, T.StructType):
        own, _, rest = rest.partition(".")
        if own not in kind.names:
            return None
        kind, field = kind[own].dataType, field[own]
    if not rest:
        return None if kind is None else (field, kind)
    if not isinstance(kind, T.StringType):
        return None
    first = value[0] if isinstance(value, (list, tuple)) and value else value
    kind = T.BooleanType() if isinstance(first, bool) else T.DoubleType() if isinstance(first, (int, float)) else T.StringType()
    path = "$" + "".join("['" + p.replace("\\", "\\\\").replace("'", "\\'") + "']" for p in rest.split("."))
    return F.try_variant_get(F.try_parse_json(field), path, kind.simpleString()), kind


def lenient(docs: DataFrame, tree: Mapping) -> Column:
    """A tree of comparisons as a predicate that never fails: what cannot be compared does not match.

    ``{"all": [...]}``, ``{"any": [...]}``, ``{"not": tree}``, or one comparison
    ``{"field": name, op: value}`` with op ``eq``, ``lt``, ``le``, ``gt``, ``ge``, ``in`` (a list), ``like`` (a glob
    on text) or ``exists`` (true or false). The value takes the field's type, so the field itself is compared as it
    is stored and the comparison reaches the scan; text that is no number, date or boolean matches nothing where one
    is stored. Of an array any element may match. Null and unknown fields do not match; ``not`` then holds. (A comparison
    with a null field stays null, which a filter takes as no match and the scan can push down.)
    """
    if "all" in tree or "any" in tree:
        parts = [lenient(docs, t) for t in tree.get("all", tree.get("any"))]
        out = F.lit("all" in tree)
        for p in parts:
            out = out & p if "all" in tree else out | p
        return out
    if "not" in tree:
        return ~F.coalesce(lenient(docs, tree["not"]), F.lit(False))
    (op, value), = ((k, v) for k, v in tree.items() if k != "field")
    if op not in (*COMPARE, "in", "like", "exists"):
        raise ValueError(f"unknown comparison {op}")
    found = _resolve(docs, tree["field"], value)
    if op == "exists":
        there = F.lit(False) if found is None else found[0].isNotNull()
        return there if value else ~there
    return F.lit(False) if found is None else _compare(*found, op, value)


Predicate = Column | str | Mapping | None


def _pred(docs: DataFrame, p: Predicate) -> Column:
    if p is None:
        return F.lit(True)
    if isinstance(p, Mapping):
        return lenient(docs, p)
    return F.expr(p) if isinstance(p, str) else p


def _scoped(docs: DataFrame, index: str | None, allowed: Sequence[str] | None, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``run`` over the documents of the requested indices, or its guard row saying why there are none.

    ``index`` is a comma list of globs over ``idx``; with ``idx`` a partition column they prune whole partitions.
    ``status``: ``invalid_index``; ``not_allowed`` (a part of the list is outside the allowlist: no part is searched);
    ``unknown_index`` (no index has such a name), which is not ``no_match``.
    """
    if index is None:
        return run(docs.where(Q.index_allowed("idx", allowed)) if allowed else docs)
    why = Q.index_refusal(index, allowed)
    if why:
        return run(docs.where(F.lit(False))).withColumn("status", F.lit(why))
    own = docs.where(Q.index_glob("idx", index))
    known = own.limit(1).agg(F.count(F.lit(1))).scalar() > 0
    return run(own).withColumn("status", F.when((F.col("status") == "no_match") & ~known, "unknown_index").otherwise(F.col("status")))


def doc_line(docs: DataFrame, max_len: int = 300) -> Column:
    """One-line rendering: first non-blank message-like string field, else the JSON of the source."""
    fields = {c: F.col(c) for c in R.MESSAGE_FIELDS if c in docs.columns and dict(docs.dtypes)[c] == "string"}
    whole = F.to_json(F.struct(*[c for c in SOURCE_FIELDS if c in docs.columns]))
    return R.doc_line(fields, whole, max_len)


def doc_search(docs: DataFrame, predicate: Predicate = None, top: int = 10, sort_field: str | None = None,
               by: Sequence[str] = (), index: str | None = None, allowed: Sequence[str] | None = None) -> DataFrame:
    """Matching documents: exact total plus the top ``top``; ``status``: ``ok``, or one ``no_match`` row of total 0.

    Per group (``by``), groups without a match have no row. With ``sort_field``: descending, documents missing the field last;
    otherwise by document id. Ties break on the document id. ``index`` and ``allowed``: see ``_scoped`` for further statuses.
    """
    positive(top, "top")
    return _scoped(docs, index, allowed, lambda own: _search(own, predicate, top, sort_field, by))


def _search(docs: DataFrame, predicate: Predicate, top: int, sort_field: str | None, by: Sequence[str]) -> DataFrame:
    m = docs.where(_pred(docs, predicate))
    if sort_field and sort_field in docs.columns:
        order = [F.col(sort_field).desc_nulls_last(), F.asc("doc_id")]
    else:
        order = [F.asc("doc_id")]
    shown = top_per_group(m, list(by), order, top).select(*by, "idx", "doc_id", "ts", doc_line(m).alias("line"), "rank")
    return with_total(shown, m, list(by)).withColumn("status", F.lit("ok")) if by else with_status(shown, m)


def terms_agg(docs: DataFrame, field: str, predicate: Predicate = None, top: int = 20,
              index: str | None = None, allowed: Sequence[str] | None = None) -> DataFrame:
    """Counts per value of ``field`` among matching documents: top ``top``, ``other``, exact total.

    ``status``: ``ok``; ``no_match`` (nothing matches); ``field_absent``
    (documents match, but none has the field). Guard statuses come as a
    single row. ``index`` and ``allowed``: see ``_scoped`` for further statuses.
    """
    positive(top, "top")
    return _scoped(docs, index, allowed, lambda own: _terms(own, field, predicate, top))


def _terms(docs: DataFrame, field: str, predicate: Predicate, top: int) -> DataFrame:
    m = docs.where(_pred(docs, predicate))
    total = m.agg(F.count(F.lit(1)).alias("total"), F.count(F.col(field)).alias("with_field"))
    buckets = m.where(F.col(field).isNotNull()).groupBy(F.col(field).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    shown = top_per_group(buckets, [], [F.desc("n"), F.asc("value")], top)
    shown_sum = shown.agg(F.sum("n").alias("_shown"))
    out = attach_row(attach_row(shown, total), shown_sum).select(
        "value", "n", "rank", (F.col("with_field") - F.col("_shown")).alias("other"), "total", F.lit("ok").alias("status"))
    guard = total.select(
        F.lit(None).cast("string").alias("value"), F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("rank"),
        F.lit(None).cast("bigint").alias("other"), "total",
        F.when(F.col("total") == 0, "no_match").otherwise("field_absent").alias("status"),
        "with_field").where(F.col("with_field") == 0).drop("with_field")
    return out.unionByName(guard)


def recent_docs(docs: DataFrame, as_of: str, minutes: int = 60, predicate: Predicate = None, top: int = 50,
                time_field: str = "ts", index: str | None = None, allowed: Sequence[str] | None = None) -> DataFrame:
    """Documents with ``time_field >= as_of - minutes``, newest first, top ``top``, exact total; ``status``: ``ok`` or one ``no_match`` row.

    The range predicate is a plain column comparison, so it is pushed to
    the scan and prunes date partitions. ``index`` and ``allowed``: see ``_scoped`` for further statuses.
    """
    positive(minutes, "minutes")
    positive(top, "top")
    return _scoped(docs, index, allowed, lambda own: _recent(own, as_of, minutes, predicate, top, time_field))


def _recent(docs: DataFrame, as_of: str, minutes: int, predicate: Predicate, top: int, time_field: str) -> DataFrame:
    m = docs.where((F.col(time_field) >= Q.lookback_start(as_of, minutes=minutes)) & _pred(docs, predicate))
    shown = top_per_group(m, [], [F.desc(time_field), F.desc("doc_id")], top).select(
        "idx", "doc_id", F.substring(F.col(time_field).cast("string"), 1, 19).alias("ts19"), doc_line(m, 260).alias("line"), "rank")
    return with_status(shown, m)


def doc_bytes(docs: DataFrame) -> Column:
    """Stored size of a document: bytes of its text fields."""
    texts = [c for c, t in docs.dtypes if t == "string"]
    return sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))


def index_catalog(docs: DataFrame, pattern: str = "*", allowed: Sequence[str] | None = None, top: int = 200) -> DataFrame:
    """Per index matching ``pattern``: documents and bytes; names outside the allowlist are only counted (``n_hidden``).

    ``status``: ``ok``; with no index to show one row says why: ``all_hidden`` or ``no_match``.
    """
    per = docs.where(Q.index_glob("idx", pattern)).groupBy("idx").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(doc_bytes(docs)).alias("bytes"))
    per = per.withColumn("_visible", Q.index_allowed("idx", allowed))
    counts = per.agg(F.count_if("_visible").alias("n_visible"), F.count_if(~F.col("_visible")).alias("n_hidden"))
    shown = top_per_group(per.where("_visible"), [], [F.asc("idx")], top).drop("_visible")
    none = counts.where("n_visible = 0").withColumn("status", F.when(F.col("n_hidden") > 0, "all_hidden").otherwise("no_match"))
    return attach_row(shown, counts).withColumn("status", F.lit("ok")).unionByName(none, allowMissingColumns=True)


# ---------------------------------------------------------------- field catalog

#: Levels of nesting that the catalogue follows; what lies deeper is listed as an object (or array) where it starts.
MAX_DEPTH = 20


def _kind(sql_type: Column) -> Column:
    """Catalogue name of a Spark type: long, double, string, boolean, date, object, array; null for a JSON null."""
    t = F.upper(sql_type)
    return (F.when(t.rlike(r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\([0-9]+,0\))$"), "long")
            .when(t.rlike("^(FLOAT|DOUBLE|DECIMAL)"), "double").when(t.rlike("^(DATE|TIMESTAMP)"), "date")
            .when(t == "VOID", None).when(t.rlike("^(OBJECT|STRUCT|MAP)"), "object").otherwise(F.lower(F.regexp_replace(t, "<.*$", ""))))


def json_leaves(text: Column, prefix: str, depth: int = MAX_DEPTH) -> Column:
    """Distinct (path, kind) of the leaves of a JSON text: array of structs; null for text that is no JSON.

    Walks the VARIANT level by level: each step replaces every object by its members and every array by its elements
    (which keep the array's path, so objects in arrays are walked, too). Nulls and empty arrays name no field, an
    empty object is one of kind object. Keys are taken as they are, whatever characters they hold.
    """
    none = F.lit(None).cast("string")
    root = F.try_parse_json(text)

    def node(path, value, kind=none):
        return F.struct(path.alias("path"), value.alias("value"), kind.alias("kind"))

    def open_up(e: Column) -> Column:
        members = F.try_variant_get(e["value"], "$", "map<string,variant>")
        elements = F.try_variant_get(e["value"], "$", "array<variant>")
        return (F.when(e["kind"].isNotNull(), F.array(e))
                .when(F.size(members) > 0, F.transform(F.map_entries(members), lambda m: node(F.concat(e["path"], F.lit("."), m["key"]), m["value"])))
                .when(elements.isNotNull(), F.transform(elements, lambda x: node(e["path"], x)))
                .otherwise(F.array(node(e["path"], e["value"], F.coalesce(_kind(F.schema_of_variant(e["value"])), F.lit("null"))))))

    # most texts are shallow: once every node has its kind the levels left change nothing
    step = lambda nodes, _: F.when(F.exists(nodes, lambda e: e["kind"].isNull()), F.flatten(F.transform(nodes, open_up))).otherwise(nodes)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(depth + 1)), F.array(node(F.lit(prefix), root)), step)
    leaves = F.transform(walked, lambda e: F.struct(e["path"].alias("field"), F.coalesce(e["kind"], _kind(F.schema_of_variant(e["value"]))).alias("type")))
    return F.when(root.isNotNull(), F.array_distinct(F.filter(leaves, lambda x: x["type"] != "null")))


def field_catalog(docs: DataFrame, json_fields: Sequence[str] = ("props",), top: int = 200, by: Sequence[str] = ("idx",), depth: int = MAX_DEPTH) -> DataFrame:
    """Leaf fields and their types, per index (``by``; empty: over all indices): the table's own columns and the leaves of JSON columns.

    field, type (several, where documents disagree, joined by ``|``, and then ``conflict``), n_docs (documents that
    have it), rank by name among ``top``, n_fields (exact), n_docs_total and n_unreadable (documents with a JSON
    column that does not parse). A field of the table that is null everywhere is listed with n_docs 0. Everything is
    one pass of built-in expressions and a partial/final aggregate.
    """
    own = [(c, t) for c, t in docs.dtypes if c not in json_fields and c != "idx"]
    by = list(by)
    no = F.lit(None).cast("string")
    entry = lambda field, kind, n: F.struct(field.alias("field"), kind.alias("type"), n.cast("long").alias("n"))
    plain = [entry(F.lit(c), _kind(F.lit(t)), F.when(F.col(f"`{c}`").isNotNull(), 1).otherwise(0)) for c, t in own]
    # each text is walked once, in a projection of its own; unreadable ones have no array
    walked = docs.select("*", *[json_leaves(F.col(f"`{j}`"), j, depth).alias(f"_leaves{k}") for k, j in enumerate(json_fields)])
    found = [F.coalesce(F.col(f"_leaves{k}"), F.array().cast("array<struct<field:string,type:string>>")) for k in range(len(json_fields))]
    # each distinct (field, type) of a document once, without a count, and each field once, counted
    nested = [x for f in found for x in (F.transform(f, lambda e: entry(e["field"], e["type"], F.lit(0))),
                                         F.transform(F.array_distinct(F.transform(f, lambda e: e["field"])), lambda p: entry(p, no, F.lit(1))))]
    unreadable = F.lit(False)
    for j in json_fields:
        unreadable = unreadable | (F.col(f"`{j}`").isNotNull() & F.try_parse_json(F.col(f"`{j}`")).isNull())
    per = walked.select(*by, F.explode(F.concat(F.array(*plain), *nested)).alias("e")).select(*by, "e.*").groupBy(*by, "field").agg(
        F.array_join(F.array_sort(F.collect_set("type")), "|").alias("type"), F.sum("n").alias("n_docs"))
    per = per.withColumn("conflict", F.contains("type", F.lit("|")))
    totals = docs.groupBy(*by).agg(F.count(F.lit(1)).alias("n_docs_total"), F.count_if(unreadable).alias("n_unreadable"))
    # fields are counted by a condition that always holds but needs all columns, so that the documents are walked once for both
    n_fields = F.count_if((F.length("type") >= 0) & (F.col("n_docs") >= 0)).alias("n_fields")
    shown = top_per_group(per, by, [F.asc("field")], top)
    shown = shown.join(per.groupBy(*by).agg(n_fields), by, "left") if by else attach_row(shown, per.agg(n_fields))
    return shown.join(totals, by, "left") if by else attach_row(shown, totals)
