"""Resolution of not-modified revisits: as-of join to the latest earlier full response of the same canonical URL.

A web archive keeps a revisit record where a server answered 304: headers, no
payload. It is resolved against the latest full response captured strictly before it under the
same canonical URL:

* ``orphan``: there is none;
* ``conflict``: the revisit names a validator (entity tag, else modification date, else payload
  digest) and the response's differs; ``unverified``: it names none;
* ``etag``, ``last-modified``, ``digest``: that validator agrees.  Entity tags are compared weakly (``W/`` aside).

A resolved revisit gets the response's payload digest and length, and its
headers with those a 304 may update (``PERMITTED``) replaced by the revisit's.

The as-of join splits any URL: records are range-partitioned by (URL, time),
so a URL with a third of all records spans many partitions; inside a
partition a window looks back, and the last response of each partition's last URL (one row per
partition, on the driver) is handed to the partitions after it.  Payloads never move: ``with_payload`` fetches them by record.

Defined results: a null URL is a URL of its own (empty); records without a time come before all others and have no earlier
ones; of responses at one time the larger record id is later, and a response at a revisit's own time is not earlier; repeated
rows are kept; null headers are none; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innflow.llm.common import cut_lineage, shuffle_partitions

# Fixed by the HTTP standard (RFC 9110, 15.4.5): the header fields a 304 answer carries to update a stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that say where a visitor came from, not what is asked for.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)="


def canonical_url(url: Column | str) -> Column:
    """Host (lower-case, without ``www``, user and default port), path without a trailing slash, sorted untracked query; no fragment."""
    u = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    parts = r"^([A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)\??([^#]*)"
    host = F.regexp_replace(F.lower(F.regexp_extract(u, parts, 2)), r"^.*@", "")
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(u, parts, 3), r"/+$", "")
    asked = F.array_sort(F.filter(F.split(F.regexp_extract(u, parts, 4), "&"), lambda q: (q != "") & ~q.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(asked, "&"))).otherwise(F.lit("")))


def header(headers: Column, name: str) -> Column:
    """Value of the first header of that (lower-case) name, or null."""
    found = F.filter(headers, lambda h: F.lower(h["name"]) == name)
    return F.when(F.size(found) > 0, F.element_at(F.when(F.size(found) > 0, found), 1)["value"])


def _as_of(records: DataFrame) -> DataFrame:
    """``records`` (key, t, kind, record_id, ...) with ``seen``: the latest response strictly before each, as a struct."""
    spark = records.sparkSession
    n = shuffle_partitions(spark)
    order = ["key", "t", "kind", "record_id"]
    asc = [F.col(c).asc_nulls_first() for c in order]
    ranged = records.repartitionByRange(n, *asc).withColumn("part", F.spark_partition_id())
    ranged = cut_lineage(ranged, "captures")
    full = F.when((F.col("kind") == 1) & F.col("t").isNotNull(), F.struct("t", "record_id", "etag", "modified", "digest", "length", "headers"))
    ends = ranged.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    tail = ranged.join(F.broadcast(ends.select(F.col("part").alias("_p"), "last")), F.col("part") == F.col("_p"))
    tail = tail.where((F.col("key") == F.col("last")) & full.isNotNull()).groupBy("part").agg(
        F.max_by("record_id", F.struct("t", "record_id")).alias("record_id"), F.max("t").alias("t"))
    spans = {r["part"]: (r["first"], r["last"]) for r in ends.collect()}
    tails = {r["part"]: (r["t"], r["record_id"]) for r in tail.collect()}
    carried, open_key, open_tail = [], None, None
    for part in sorted(spans):
        first, last = spans[part]
        if open_tail is not None and first == open_key:
            carried.append((part, first, *open_tail))
        if last != open_key:
            open_key, open_tail = last, None
        open_tail = tails.get(part, open_tail)
    carry = spark.createDataFrame(carried, "part int, key string, t long, record_id long")
    # the carried responses themselves: at most one per partition
    handed = ranged.where("kind = 1").withColumnRenamed("part", "_from").join(F.broadcast(carry), ["key", "t", "record_id"])
    handed = handed.groupBy("part", "key").agg(
        F.first(F.struct("t", "record_id", "etag", "modified", "digest", "length", "headers")).alias("handed"))
    back = Window.partitionBy("part", "key").orderBy(*[F.col(c).asc_nulls_first() for c in order[1:]]).rowsBetween(
        Window.unboundedPreceding, -1)
    near = ranged.withColumn("near", F.last(full, ignorenulls=True).over(back)).where("kind = 0")
    joined = near.join(F.broadcast(handed), ["part", "key"], "left")
    return joined.withColumn("seen", F.when(F.col("t").isNotNull(), F.coalesce("near", "handed"))).drop("near", "handed", "part")


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit of ``records``.

    Input: ``record_id`` long, ``url`` string, ``captured_at`` long (seconds), ``kind`` string ('response' or 'revisit'),
    ``headers`` array of (name, value), ``payload_sha256`` string, ``payload_length`` long.  Result: ``record_id, url_key,
    captured_at, outcome, refers_to, status, payload_sha256, payload_length, headers``.
    """
    h = F.coalesce("headers", F.array().cast("array<struct<name:string,value:string>>"))
    events = records.where("kind in ('response', 'revisit')").select(
        canonical_url("url").alias("key"), F.col("captured_at").alias("t"), (F.col("kind") == "response").cast("int").alias("kind"),
        "record_id", header(h, "etag").alias("etag"), header(h, "last-modified").alias("modified"),
        F.col("payload_sha256").alias("digest"), F.col("payload_length").alias("length"), h.alias("headers"))
    met = _as_of(events)
    tag = lambda c: F.regexp_replace(c, "^W/", "")
    s = F.col("seen")
    agrees = lambda ok, name: F.when(F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(F.lit("conflict"))
    outcome = (F.when(s.isNull(), "orphan")
               .when(F.col("etag").isNotNull(), agrees(tag(F.col("etag")) == tag(s["etag"]), "etag"))
               .when(F.col("modified").isNotNull(), agrees(F.col("modified") == s["modified"], "last-modified"))
               .when(F.col("digest").isNotNull(), agrees(F.col("digest") == s["digest"], "digest"))
               .otherwise("unverified"))
    done = F.col("outcome").isin("etag", "last-modified", "digest")
    new = F.filter("headers", lambda x: F.lower(x["name"]).isin(*PERMITTED))
    names = F.transform(new, lambda x: F.lower(x["name"]))
    merged = F.concat(F.filter(s["headers"], lambda x: ~F.array_contains(names, F.lower(x["name"]))), new)
    own = F.transform(F.when(done, merged).otherwise(F.col("headers")),
                      lambda x: F.concat(F.lower(x["name"]), F.lit(": "), F.coalesce(x["value"], F.lit(""))))
    return met.withColumn("outcome", outcome).select(
        "record_id", F.col("key").alias("url_key"), F.col("t").alias("captured_at"), "outcome",
        s["record_id"].alias("refers_to"), F.when(done, 200).otherwise(304).alias("status"),
        F.when(done, s["digest"]).alias("payload_sha256"), F.when(done, s["length"]).alias("payload_length"),
        F.array_join(F.array_sort(own), "\n").alias("headers"))


def with_payload(resolved: DataFrame, payloads: DataFrame) -> DataFrame:
    """Resolved revisits with the payload of the response they refer to (``payloads``: record_id, payload)."""
    of = payloads.select(F.col("record_id").alias("_of"), "payload")
    return resolved.where("status = 200").join(of, F.col("refers_to") == F.col("_of")).drop("_of")


def capture_log(pages: DataFrame) -> DataFrame:
    """Records of every page: one full response, and up to three revisits whose validators agree, differ or lack by its id.

    The supplied pages hold no revisits, so this states by arithmetic on ``page_id`` when each page was fetched
    and checked again; validators and digests come from the page itself, and pages of one canonical URL share a history.
    """
    p = pages.select(
        "page_id", "url", F.md5(F.coalesce("html", F.lit("")).cast("binary")).alias("m"),
        F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("sha"),
        F.octet_length(F.coalesce("html", F.lit(""))).cast("bigint").alias("size"),
        (F.lit(1704067200) + F.col("page_id") * 60).alias("t0"))
    h = lambda *pairs: "array_compact(array(" + ", ".join(
        f"if({cond}, named_struct('name', '{name}', 'value', {value}), null)" for name, value, cond in pairs) + "))"
    tag = "concat('\"', substring(m, 1, 16), '\"')"
    responses = p.select(
        F.expr("page_id * 8").alias("record_id"), "url", F.col("t0").alias("captured_at"), F.lit("response").alias("kind"),
        F.expr(h(("Content-Type", "'text/html'", "true"), ("Content-Length", "cast(size as string)", "true"),
                 ("ETag", tag, "page_id % 11 <> 0"), ("Last-Modified", "cast(t0 - page_id % 7 * 86400 as string)", "true"),
                 ("Cache-Control", "'max-age=600'", "true"), ("Date", "cast(t0 as string)", "true"))).alias("headers"),
        F.col("sha").alias("payload_sha256"), F.col("size").alias("payload_length"))
    again = p.select("*", F.explode(F.expr("filter(array(1L, 2L, 3L), k -> k <= page_id % 4)")).alias("k")).withColumn(
        "v", F.expr("(page_id + k) % 6")).withColumn("t", F.expr("if(page_id % 13 = 0, t0 - k * 3600, t0 + k * 86400)"))
    revisits = again.select(
        F.expr("page_id * 8 + k").alias("record_id"), "url", F.col("t").alias("captured_at"), F.lit("revisit").alias("kind"),
        F.expr(h(("date", "cast(t as string)", "true"), ("cache-control", "concat('max-age=', k)", "true"),
                 ("content-length", "'0'", "true"), ("etag", tag, "v = 0"), ("etag", f"concat('W/', {tag})", "v = 1"),
                 ("etag", "'\"other\"'", "v = 2"),
                 ("last-modified", "cast(t0 - page_id % 7 * 86400 as string)", "v = 3"))).alias("headers"),
        F.expr("if(v = 4, sha, null)").alias("payload_sha256"), F.lit(None).cast("bigint").alias("payload_length"))
    return responses.unionByName(revisits)


ORACLE = r"""
with p as (select page_id, coalesce(url, '') as u, md5(coalesce(html, '')) as m, sha256(coalesce(html, '')) as sha,
                  strlen(coalesce(html, ''))::bigint as size, 1704067200 + page_id * 60 as t0 from pages),
c as (select *, regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)\??([^#]*)', 2) as host,
             regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)\??([^#]*)', 3) as path,
             list_sort(list_filter(string_split(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)\??([^#]*)', 4), '&'),
                       lambda q: q <> '' and not regexp_matches(q, '^(utm_[a-z]+|ref|fbclid|gclid)='))) as asked from p),
k as (select page_id, m, sha, size, t0, '"' || substr(m, 1, 16) || '"' as tag,
             regexp_replace(regexp_replace(regexp_replace(lower(host), '^.*@', ''), ':(80|443)$', ''), '^www[0-9]*\.', '')
             || regexp_replace(path, '/+$', '') || case when len(asked) > 0 then '?' || array_to_string(asked, '&') else '' end as key from c),
events as (
    select key, t0 as t, 1 as kind, page_id * 8 as record_id, case when page_id % 11 <> 0 then tag end as etag,
           (t0 - page_id % 7 * 86400)::varchar as modified, sha as digest, size, page_id, t0, 0 as n from k
    union all
    select key, case when page_id % 13 = 0 then t0 - n * 3600 else t0 + n * 86400 end, 0, page_id * 8 + n,
           case (page_id + n) % 6 when 0 then tag when 1 then 'W/' || tag when 2 then '"other"' end,
           case when (page_id + n) % 6 = 3 then (t0 - page_id % 7 * 86400)::varchar end,
           case when (page_id + n) % 6 = 4 then sha end, null, page_id, t0, n
    from k, (values (1), (2), (3)) x(n) where n <= page_id % 4),
met as (select *, last_value(case when kind = 1 then struct_pack(record_id := record_id, etag := etag, modified := modified, digest := digest,
                                                                  size := size, t0 := t0, page_id := page_id) end ignore nulls)
                  over (partition by key order by t, kind, record_id rows between unbounded preceding and 1 preceding) as s from events),
judged as (select *, case when s is null then 'orphan'
        when etag is not null then case when regexp_replace(etag, '^W/', '') = s.etag then 'etag' else 'conflict' end
        when modified is not null then case when modified = s.modified then 'last-modified' else 'conflict' end
        when digest is not null then case when digest = s.digest then 'digest' else 'conflict' end
        else 'unverified' end as outcome from met where kind = 0),
done as (select *, outcome in ('etag', 'last-modified', 'digest') as ok from judged)
select record_id, key as url_key, t as captured_at, outcome, s.record_id as refers_to, case when ok then 200 else 304 end::int as status,
       case when ok then s.digest end as payload_sha256, case when ok then s.size end as payload_length,
       array_to_string(list_sort(list_filter(case when ok then
           ['cache-control: max-age=' || n, 'content-length: ' || s.size, 'content-type: text/html', 'date: ' || t,
            'etag: ' || coalesce(etag, s.etag), 'last-modified: ' || s.modified]
           else ['cache-control: max-age=' || n, 'content-length: 0', 'date: ' || t, 'etag: ' || etag, 'last-modified: ' || modified] end,
           lambda x: x is not null)), chr(10)) as headers
from done
"""
