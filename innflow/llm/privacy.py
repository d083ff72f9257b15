"""Information-theoretic sanitisation: base identifiers by pattern, and the terms that give them away.

Base identifiers (e-mail, IP address, card, phone) protect entities: the exact value, what it belongs to (mail domain,
/24 network, issuer digits of a card, first digits of a phone number) and its kind.  Over all documents, with n documents,

    IC(c)     = log2(n / n_c)                surprise of entity c
    PMI(c; t) = log2(n * n_ct / (n_c * n_t)) what term t tells about it
    share     = PMI / IC                     1: the term occurs only in documents that hold the entity

where n_c, n_t, n_ct count documents that hold the entity, the term, and both: all terms of a text count, wherever
they stand.  A pair needs ``SUPPORT`` different texts (copies are no evidence) and ``CHANCE_BITS`` bits: so many different
texts would hold an entity of that surprise by chance once in 2^bits.  A term whose share reaches ``REMOVE`` is removed,
one that reaches ``GENERALISE`` replaced by a placeholder, at every occurrence in every document that it endangers, that is which
holds the entity.  A document without a base identifier is never changed.

One pass over the texts yields small rows: base spans, and for documents with an identifier (few) the hashes and places of
their terms.  n_t is an aggregate over the words of all texts, pre-aggregated before its shuffle; so are the pairs, after
copies have become one row and entities of too few texts have gone.  A pair of
very many documents is one row on the aggregated side of each join, so the other side's rows can be split.

Defined results: null text is empty and has no spans; rows with equal id and
text count as documents and are each kept; ids may be null; extra columns stay in ``sanitise``
(columns named ``_pv_*`` are reserved).  Spans are code points, end exclusive.  Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innflow.llm.common import cut_lineage, ship, text_or_empty

# Fixed order of the base kinds in lists of spans; the method's own kinds follow.
KINDS = ("email", "ip", "card", "phone")
METHOD_KINDS = ("generalise", "remove")
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalise": "[TERM]", "remove": ""}
SUPPORT = 3
CHANCE_BITS = 30
BROADCAST_ROWS = 200_000
GENERALISE, REMOVE = 0.75, 0.95

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Starting inside a run of digits finds nothing that its first digit does not, so a look-behind keeps the scan linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]+")
_TERM_JVM = r"[^\p{L}\p{N}]+"
# Any text with a base span matches; few others do.
_MAYBE = r"@|\+[0-9]|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|[0-9]([ -]?[0-9]){12}"


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each ``@`` outwards (linear in the text)."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each base kind, in order of their starts."""
    out = {"email": emails(text) if "@" in text else []}
    out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    out["card"] = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
    out["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15] if "+" in text else []
    return out


def entity_value(kind: str, matched: str) -> str:
    """What two mentions of one entity share: lower-cased address, or the digits (and dots of an IP address)."""
    return matched.lower() if kind == "email" else "".join(c for c in matched if c in "0123456789" or (c == "." and kind == "ip"))


def entities(text: str, spans: dict[str, list[tuple[int, int]]]) -> list[str]:
    """What the base spans of a text protect: each exact value, what it belongs to, and its kind."""
    found = set()
    for kind, places in spans.items():
        for a, b in places:
            value = entity_value(kind, text[a:b])
            part = {"email": value.rpartition("@")[2], "ip": value.rpartition(".")[0], "card": value[:6], "phone": value[:5]}[kind]
            found |= {f"{kind}={value}", f"{kind}~{part}", kind}
    return sorted(found)


def term_places(text: str, spans: dict[str, list[tuple[int, int]]]) -> tuple[list[int], list[int], list[int]]:
    """Hash (as ``xxhash64`` of the lower-cased term), start and end of every term that does not touch a base span."""
    blocked = sorted(x for places in spans.values() for x in places)
    hashes, starts, ends, k, reach = [], [], [], 0, 0
    for m in _TERM.finditer(text):
        a, b = m.span()
        while k < len(blocked) and blocked[k][0] < b:
            reach = max(reach, blocked[k][1])
            k += 1
        if a >= reach:
            h = xxhash.xxh64_intdigest(m[0].lower().encode("utf-8", "surrogatepass"), 42)
            hashes.append(h - (1 << 64) if h >> 63 else h)
            starts.append(a)
            ends.append(b)
    return hashes, starts, ends


def _spelled(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_base(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """One row per document: id, text hash, counts, base spans as text and their digest; entities and term places where it has a base span."""
    ship(docs.sparkSession)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for t in pdf["t"]:
                t = t or ""
                spans = base_spans(t)
                spelled = _spelled([(k, a, b) for k in KINDS for a, b in spans[k]])
                held = (entities(t, spans), *term_places(t, spans)) if spelled else ([], [], [], [])
                rows.append((*[len(spans[k]) for k in KINDS], hashlib.sha256(spelled.encode()).hexdigest(), spelled, *held))
            frame = pd.DataFrame(rows, columns=[*[f"n_{k}" for k in KINDS], "base_sha256", "base", "entities", "terms", "starts", "ends"])
            frame.insert(0, "id", pd.array([None if pd.isna(i) else int(i) for i in pdf["id"]], dtype="Int64"))
            frame.insert(1, "h", pdf["h"].to_numpy())
            yield frame

    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    return narrow.mapInPandas(scan, "id long, h long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
                                    "entities array<string>, terms array<long>, starts array<int>, ends array<int>")


def term_documents(docs: DataFrame, text: str) -> DataFrame:
    """``term_hash, n_t``: in how many documents each term occurs, over all words of all documents."""
    terms = F.array_distinct(F.split(F.lower(text_or_empty(text)), _TERM_JVM))
    words = docs.select(F.explode(terms).alias("w")).where("w <> ''")
    return words.groupBy(F.xxhash64("w").alias("term_hash")).agg(F.count(F.lit(1)).alias("n_t"))


def together(held: DataFrame, listed: DataFrame) -> DataFrame:
    """The columns of ``held`` but its lists, ``entity`` and ``term``: every listed entity of a document with every different term of it.

    ``listed`` (``_e``) is a small part of all entities, so it meets the few entities of a document before the terms are spread.
    """
    keep = [c for c in held.columns if c not in ("entities", "terms")]
    some = F.broadcast(listed) if listed.count() <= BROADCAST_ROWS else listed
    one = held.select(*keep, F.array_distinct("terms").alias("t"), F.explode("entities").alias("entity"))
    return one.join(some, F.col("entity") == F.col("_e"), "left_semi").select(*keep, "entity", F.explode("t").alias("term"))


def disclosing_terms(held: DataFrame, n_t: DataFrame, n_docs: int) -> DataFrame:
    """``entity, term, kind``: pairs whose share reaches a threshold, with what is to be done to the term.  ``held``: rows with entities.

    Copies become one row with their number first, and entities of too few texts go, so pairs are counted with map-side combining.
    """
    texts = held.groupBy("h").agg(F.count(F.lit(1)).alias("rows"), F.any_value("entities").alias("entities"), F.any_value("terms").alias("terms"))
    texts = cut_lineage(texts, "private_texts")
    n, surprise = F.lit(float(n_docs)), F.log2(F.lit(float(n_docs)) / F.col("n_c"))
    n_c = texts.select("rows", F.explode("entities").alias("_e")).groupBy("_e").agg(F.sum("rows").alias("n_c"), F.count(F.lit(1)).alias("different"))
    # no pair of an entity can have more texts than the entity
    n_c = cut_lineage(n_c.where((F.col("different") >= SUPPORT) & (F.col("different") * surprise >= CHANCE_BITS)).select("_e", "n_c"), "private_entities")
    n_ct = together(texts.drop("h"), n_c.select("_e")).groupBy("entity", "term").agg(F.sum("rows").alias("n_ct"), F.count(F.lit(1)).alias("texts")).where(
        F.col("texts") >= SUPPORT)
    pairs = n_ct.join(n_c, n_ct["entity"] == n_c["_e"]).where(F.col("texts") * surprise >= CHANCE_BITS)
    pairs = pairs.join(n_t, pairs["term"] == n_t["term_hash"], "left")
    seen = F.greatest(F.coalesce("n_t", "n_ct"), F.col("n_ct")).cast("double")
    share = F.log2(n * F.col("n_ct") / (F.col("n_c") * seen)) / surprise
    return pairs.withColumn("share", share).where(F.col("share") >= GENERALISE).select(
        "entity", "term", F.when(F.col("share") >= REMOVE, "remove").otherwise("generalise").alias("kind"))


def find_private(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, h, n_email, n_ip, n_card, n_phone, base_sha256, base, added`` per row; ``added`` spells the method's spans."""
    base = cut_lineage(find_base(docs, id_col, text), "private_base")
    held = base.where("base <> ''").select("id", "h", "entities", "terms", "starts", "ends")
    pairs = cut_lineage(disclosing_terms(held, term_documents(docs, text), base.count()), "private_pairs")
    named = pairs.select(F.col("entity").alias("_e"), F.col("term").alias("_t"), "kind")
    # a row repeated with the same id and text has equal spans: one stands for all
    one = held.dropDuplicates(["id", "h"])
    named = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
    met = together(one.drop("starts", "ends"), named.select("_e").distinct())
    hits = met.join(named, (met["entity"] == named["_e"]) & (met["term"] == named["_t"])).groupBy("id", "h", "term").agg(
        F.max("kind").alias("kind"))  # removal wins where two entities ask for different ones
    hits = cut_lineage(hits, "private_hits").select(F.col("id").alias("_id"), F.col("h").alias("_h"), F.col("term").alias("_t"), "kind")
    spots = one.select("id", "h", F.explode(F.arrays_zip("terms", "starts", "ends")).alias("x")).select("id", "h", "x.*")
    spans = spots.join(hits, spots["id"].eqNullSafe(hits["_id"]) & (spots["h"] == hits["_h"]) & (spots["terms"] == hits["_t"]))
    added = spans.groupBy(F.col("id").alias("_id"), F.col("h").alias("_h")).agg(
        F.array_sort(F.collect_list(F.struct("kind", F.col("starts").alias("start"), F.col("ends").alias("end")))).alias("found"))
    spelled = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    added = added.select("_id", "_h", spelled.alias("added"))
    rows = base.drop("entities", "terms", "starts", "ends")
    return rows.join(added, rows["id"].eqNullSafe(added["_id"]) & (rows["h"] == added["_h"]), "left").drop("_id", "_h")


def all_spans(base: Column, added: Column) -> Column:
    return F.concat_ws(",", F.when(base != "", base), added)


def private_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, counts of the base kinds, digest of the base spans, and all spans as text."""
    found = find_private(docs, id_col, text)
    return found.select(F.col("id").alias(id_col), *[f"n_{k}" for k in KINDS], "base_sha256",
                        all_spans(F.col("base"), F.col("added")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span of the list replaced by its kind's mask; a span that overlaps one before it extends that one's reach.

    Native, so texts without spans (null list) pass through untouched and none is sent to Python.
    """
    masks = F.create_map(*[F.lit(x) for kv in MASKS.items() for x in kv])
    part = lambda s, n: F.split_part(s, F.lit(":"), F.lit(n))
    listed = F.transform(F.split(spans, ","), lambda s: F.struct(
        part(s, 2).cast("int").alias("a"), (-part(s, 3).cast("int")).alias("minus_b"), masks[part(s, 1)].alias("mask")))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["a"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["a"] - acc["at"]), s["mask"])).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], -s["minus_b"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate(F.array_sort(listed), start, step,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.lit(2**31 - 1))))
    return F.when(spans.isNull(), text).otherwise(done)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the spans of every text masked; texts without spans are unchanged.

    Texts that cannot hold a base identifier (most) pass by the join with the spans, so only the others are moved.
    """
    found = find_private(docs, id_col, text)
    spans = found.select(F.col("id").alias("_pv_id"), F.col("h").alias("_pv_h"),
                         all_spans(F.col("base"), F.col("added")).alias("_pv_spans"))
    spans = spans.where("_pv_spans <> ''").dropDuplicates(["_pv_id", "_pv_h"])
    columns, maybe = [F.col(f"`{c}`") for c in docs.columns], F.coalesce(F.col(text).rlike(_MAYBE), F.lit(False))
    keyed = docs.where(maybe).withColumn("_pv_of", F.xxhash64(text))
    joined = keyed.join(spans, keyed[id_col].cast("bigint").eqNullSafe(spans["_pv_id"]) & (keyed["_pv_of"] == spans["_pv_h"]), "left")
    done = joined.withColumn(text, masked(F.col(text), F.col("_pv_spans"))).select(*columns)
    return done.unionByName(docs.where(~maybe).select(*columns))
