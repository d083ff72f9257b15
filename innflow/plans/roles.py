"""Raw booking extracts derived from the supplied tables.

The supplied tables are clean; the booking job needs messy text.  Each raw
entity here is a plan over a supplied table (so its size grows with it)
with deterministic faults injected by key arithmetic:

=============  ==============  ==================================================
entity         from            key / roles
=============  ==============  ==================================================
properties     nation, region  property_id = n_nationkey; regions add 5 more
rooms          supplier        room_id = s_suppkey, property_id = s_nationkey
guests         customer        guest_id = c_custkey, names split at '#'
reservations   orders          check_in = o_orderdate, check_out = last ship
                               date of the order, room = max supplier of it
payments       lineitem        one payment per line, amount = extended price
=============  ==============  ==================================================

All columns are text, as a CSV extract would be; ``_seq`` is the arrival
order used by keep-first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innflow.functions import vocab as V
from innflow.operators import mess
from innflow.operators.membership import broadcast_if_small
from innflow.sources.tables import Tables

RAW_COLUMNS = {
    "guests": ["guest_id", "first_name", "last_name", "email", "phone", "country"],
    "properties": ["property_id", "property_name", "city", "country"],
    "rooms": ["room_id", "property_id", "room_type", "capacity"],
    "reservations": [
        "reservation_id", "guest_id", "property_id", "room_id",
        "check_in_date", "check_out_date", "booking_status", "booking_date",
    ],
    "payments": ["payment_id", "reservation_id", "payment_date", "payment_method", "amount", "payment_status"],
}

# Raw spellings of the test extracts: every alias of the status vocabularies in three casings, and texts outside them.
ROOM_TYPES = ["Single", "Twin", "Double", "Studio", "Loft"]
PAYMENT_METHODS = ["card", "wire", "cash", "voucher", "wallet", "cheque", "direct debit"]


def _spellings(aliases: dict[str, str], *others: str) -> list[str]:
    return [f(a) for a in sorted(aliases) for f in (str.lower, str.title, str.upper)] + list(others)


BOOKING_STATUS_SPELLINGS = _spellings(V.BOOKING_STATUS_ALIASES, "on request", "")
PAYMENT_STATUS_SPELLINGS = _spellings(V.PAYMENT_STATUS_ALIASES, "disputed")
# Spark patterns and, place by place, the same in strftime codes for the SQL statements; the listed formats first, then
# some that only the last-resort list reads.
DATE_TEXT_PATTERNS = ["yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy", "dd-MMM-yyyy", "yyyy/MM/dd",
                      "dd MMM yyyy", "dd.MM.yyyy", "yyyy.MM.dd", "yyyyMMdd"]
DATE_TEXT_CODES = ["%Y-%m-%d", "%d/%m/%Y", "%m-%d-%Y", "%d-%b-%Y", "%Y/%m/%d", "%d %b %Y", "%d.%m.%Y", "%Y.%m.%d", "%Y%m%d"]
TIMESTAMP_TEXT_PATTERNS = ["yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm", "MM-dd-yyyy hh:mm a",
                           "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy/MM/dd HH:mm:ss", "dd-MMM-yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS"]
TIMESTAMP_TEXT_CODES = ["%Y-%m-%d %H:%M:%S", "%d/%m/%Y %H:%M", "%m-%d-%Y %I:%M %p",
                        "%Y-%m-%dT%H:%M:%SZ", "%Y/%m/%d %H:%M:%S", "%d-%b-%Y %H:%M:%S", "%Y-%m-%d %H:%M:%S.%f"]


def _s(c: Column) -> Column:
    return c.cast("string")


def _m(k: Column, n: int, r: int) -> Column:
    return mess.every(k, n, r)


def raw_properties(t: Tables) -> DataFrame:
    nation, region = t["nation"], t["region"]
    base = nation.join(broadcast_if_small(region), nation.n_regionkey == region.r_regionkey)
    k = F.col("n_nationkey").cast("bigint")
    kid = _s(k)
    prop = base.select(
        F.when(k == 23, F.concat(F.lit("P-"), kid))
        .when(_m(k, 5, 1), F.concat(kid, F.lit(".0")))
        .when(_m(k, 5, 2), F.concat(F.lit("  "), kid, F.lit(" ")))
        .otherwise(kid).alias("property_id"),
        mess.pad(F.concat(F.lit("Hotel "), F.col("n_name")), _m(k, 7, 3)).alias("property_name"),
        mess.blank(F.concat(F.lit("City "), kid), _m(k, 10, 9)).alias("city"),
        F.col("r_name").alias("country"),
        (k * 10).alias("_seq"),
    )
    # a second row for some keys arrives later under another name: keep-first drops it
    annex = base.where(_m(k, 12, 4)).select(
        kid.alias("property_id"),
        F.concat(F.lit("Annex "), F.col("n_name")).alias("property_name"),
        F.concat(F.lit("City "), kid).alias("city"),
        F.col("r_name").alias("country"),
        (k * 10 + 5).alias("_seq"),
    )
    # one resort per region: properties that own no rooms and no bookings
    rk = F.col("r_regionkey").cast("bigint")
    resorts = region.select(
        _s(rk + 100).alias("property_id"),
        F.concat(F.lit("Resort "), F.col("r_name")).alias("property_name"),
        F.concat(F.lit("Coast "), F.col("r_name")).alias("city"),
        F.col("r_name").alias("country"),
        (rk + 1000).alias("_seq"),
    )
    return prop.unionByName(annex).unionByName(resorts)


def raw_rooms(t: Tables) -> DataFrame:
    s = t["supplier"]
    k = F.col("s_suppkey").cast("bigint")
    kid = _s(k)
    rooms = s.select(
        F.when(_m(k, 43, 42), F.concat(F.lit("R"), kid))
        .when(_m(k, 9, 4), F.concat(kid, F.lit(".0")))
        .when(_m(k, 9, 7), F.concat(F.lit("\t"), kid))
        .otherwise(kid).alias("room_id"),
        _s(mess.orphan_reference(F.col("s_nationkey").cast("bigint"), _m(k, 31, 30), 1000)).alias("property_id"),
        mess.blank(mess.pick(ROOM_TYPES, k), _m(k, 47, 46)).alias("room_type"),
        F.when(_m(k, 37, 36), F.lit("0")).when(_m(k, 41, 40), F.lit("40000")).otherwise(_s(F.pmod(k, F.lit(6)) + 1)).alias("capacity"),
        (k * 2).alias("_seq"),
        k.alias("_k"),
    )
    rooms = mess.duplicate_rows(rooms, _m(F.col("_k"), 19, 5), "_seq", 1)
    return rooms.drop("_k")


def raw_guests(t: Tables) -> DataFrame:
    c, nation = t["customer"], t["nation"]
    base = c.join(broadcast_if_small(nation.select("n_nationkey", "n_name")), c.c_nationkey == F.col("n_nationkey"), "left")
    k = F.col("c_custkey").cast("bigint")
    kid = _s(k)
    first = F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))
    last = F.split_part(F.col("c_name"), F.lit("#"), F.lit(2))
    email = F.concat(F.lower(first), F.lit("."), last, F.lit("@example.com"))
    phone = F.concat(
        F.lit("+"), _s(F.col("c_nationkey") + 1), F.lit("-555-"), F.lpad(_s(F.pmod(k, F.lit(10000))), 4, "0")
    )
    guests = base.select(
        F.when(_m(k, 89, 4), F.concat(F.lit("G-"), kid))
        .when(_m(k, 83, 50), _s(k + 3_000_000_000))
        .when(_m(k, 7, 2), F.concat(kid, F.lit(".0")))
        .when(_m(k, 11, 3), F.concat(F.lit(" "), kid, F.lit(" ")))
        .when(_m(k, 13, 6), F.concat(F.lit("+"), kid))
        .otherwise(kid).alias("guest_id"),
        F.when(_m(k, 97, 5), F.lit("")).when(_m(k, 79, 11), F.repeat(F.lit("x"), 101)).when(_m(k, 20, 3), F.concat(F.lit("  "), first, F.lit("  ")))
        .otherwise(first).alias("first_name"),
        F.when(_m(k, 101, 7), F.lit("nan")).when(_m(k, 20, 8), F.concat(last, F.lit("\t")))
        .otherwise(last).alias("last_name"),
        mess.blank(mess.upper_some(email, _m(k, 5, 0)), _m(k, 33, 0)).alias("email"),
        mess.blank(phone, _m(k, 19, 0)).alias("phone"),
        F.when(_m(k, 50, 0) | F.col("n_name").isNull(), F.lit("")).otherwise(F.col("n_name")).alias("country"),
        (k * 8 + 4).alias("_seq"),
        k.alias("_k"),
    )
    kk = F.col("_k")
    guests = mess.with_copies(guests, "_seq", [
        # an exact re-send, arriving right after the original
        (_m(kk, 50, 1), 1, {}),
        # the same person re-entered under a new id
        (_m(kk, 31, 0), 2, {"guest_id": _s(kk + 1_000_000_000)}),
        # a broken copy (no first name) arriving before the good row with the same id
        (_m(kk, 61, 9), -3, {"first_name": F.lit("")}),
    ])
    return guests.drop("_k")


def raw_reservations(t: Tables) -> DataFrame:
    return _reservations_of(_bookings(t))


def _bookings(t: Tables) -> DataFrame:
    """The orders that become bookings, re-sends and later records included: numbers and dates, no text yet."""
    o, li, s = t["orders"], t["lineitem"], t["supplier"]
    per_order = li.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("_last_ship"), F.max("l_suppkey").alias("_room")
    )
    rooms = broadcast_if_small(s.select("s_suppkey", "s_nationkey"))
    base = o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left").join(
        rooms, F.col("_room") == F.col("s_suppkey"), "left"
    )
    k = F.col("o_orderkey").cast("bigint")
    rows = base.select("o_custkey", "o_orderdate", "s_nationkey", "_room", "_last_ship", F.lit(False).alias("_later"),
                       (k * 4).alias("_seq"), k.alias("_k"))
    kk = F.col("_k")
    return mess.with_copies(rows, "_seq", [
        # exact re-sends of some bookings
        (_m(kk, 67, 0), 1, {}),
        # a later record under the same id with another status: keep-first decides
        (_m(kk, 71, 5), 2, {"_later": F.lit(True)}),
    ])


def _reservations_of(bookings: DataFrame) -> DataFrame:
    """One reservation per row of ``_bookings``, in their order."""
    k = F.col("_k")
    rid = F.concat(F.lit("RES-"), _s(k))
    cust = F.col("o_custkey").cast("bigint")
    booked = F.timestamp_add(
        "MINUTE",
        (-(F.pmod(k, F.lit(60)) + 1) * 1440 + F.pmod(k, F.lit(24)) * 60 + F.pmod(k, F.lit(60))).cast("int"),
        F.col("o_orderdate"),
    )
    room = F.col("_room").cast("bigint")
    return bookings.select(
        F.when(_m(k, 113, 7), F.lit("")).when(_m(k, 23, 5), F.concat(F.lit("  "), rid, F.lit(" ")))
        .otherwise(rid).alias("reservation_id"),
        F.when(_m(k, 211, 11), _s(cust + 2_000_000_000))
        # no integer, though any rounding would make one; and integers written long
        .when(_m(k, 223, 5), F.concat(_s(cust), F.lit("." + "9" * 20)))
        .when(_m(k, 227, 7), F.concat(_s(cust), F.lit("." + "0" * 24))).when(_m(k, 229, 9), F.concat(_s(cust), F.lit("00e-2")))
        .when(_m(k, 17, 3), F.concat(_s(cust), F.lit(".0")))
        .otherwise(_s(cust)).alias("guest_id"),
        F.coalesce(_s(F.col("s_nationkey")), F.lit("")).alias("property_id"),
        F.when(room.isNull(), F.lit("")).when(_m(k, 199, 13), _s(room + 5_000_000))
        .otherwise(_s(room)).alias("room_id"),
        F.when(_m(k, 127, 3), F.lit("")).when(_m(k, 131, 4), F.lit("TBD"))
        .otherwise(mess.format_variant(F.col("o_orderdate"), k, DATE_TEXT_PATTERNS)).alias("check_in_date"),
        F.when(F.col("_last_ship").isNull() | _m(k, 100, 1), F.lit(""))
        .otherwise(mess.format_variant(F.col("_last_ship"), F.floor(k / 5), DATE_TEXT_PATTERNS)).alias("check_out_date"),
        F.when(F.col("_later"), F.lit("pending"))
        .otherwise(mess.pad(mess.pick(BOOKING_STATUS_SPELLINGS, k), _m(k, 9, 2), " ", " ")).alias("booking_status"),
        F.when(_m(k, 137, 9), F.lit(""))
        .otherwise(mess.format_variant(booked, F.floor(k / 25), TIMESTAMP_TEXT_PATTERNS)).alias("booking_date"),
        "_seq",
    )


# the arrival order of a payment (its ``_seq``), by the columns of its line
PAYMENT_ORDER = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"]


def raw_payments(t: Tables) -> DataFrame:
    return _payments_of(t["lineitem"])


def _payments_of(li: DataFrame) -> DataFrame:
    """One payment per line, in the order of the lines."""
    ok = F.col("l_orderkey").cast("bigint")
    ln = F.col("l_linenumber").cast("bigint")
    part = F.col("l_partkey").cast("bigint")
    h = ok * 7 + ln
    pid = F.concat(F.lit("PMT-"), _s(ok), F.lit("-"), _s(ln))
    amt = _s(F.col("l_extendedprice").cast("decimal(12,2)"))
    paid_at = F.timestamp_add("MINUTE", F.pmod(ln * 97 + ok, F.lit(1440)).cast("int"), F.col("l_shipdate"))
    return li.select(
        F.when(_m(h, 211, 17), F.lit("")).when(_m(h, 29, 3), F.concat(F.lit(" "), pid, F.lit("  ")))
        .otherwise(pid).alias("payment_id"),
        F.when(_m(ok, 97, 0), F.concat(F.lit("RES-X"), _s(ok)))
        .otherwise(F.concat(F.lit("RES-"), _s(ok))).alias("reservation_id"),
        F.when(_m(h, 53, 1), F.lit("")).when(_m(h, 59, 2), F.lit("n/a"))
        .otherwise(mess.format_variant(paid_at, h, TIMESTAMP_TEXT_PATTERNS)).alias("payment_date"),
        mess.blank(mess.pick(PAYMENT_METHODS, part), _m(part, 251, 17)).alias("payment_method"),
        F.when(_m(h, 101, 3), F.lit("")).when(_m(h, 103, 5), F.lit("N/A"))
        .when(_m(h, 83, 0), F.concat(F.lit("-"), amt)).when(_m(h, 89, 6), F.concat(F.lit("98765"), amt))
        .when(_m(h, 13, 4), F.concat(F.lit(" "), amt, F.lit(" ")))
        .otherwise(amt).alias("amount"),
        mess.pick(PAYMENT_STATUS_SPELLINGS, part + ln).alias("payment_status"),
        F.struct(
            ok.alias("orderkey"), ln.alias("linenumber"), F.col("l_shipdate").alias("shipdate"),
            part.alias("partkey"), F.col("l_suppkey").cast("bigint").alias("suppkey"),
        ).alias("_seq"),
    )


RAW_BUILDERS = {
    "properties": raw_properties,
    "rooms": raw_rooms,
    "guests": raw_guests,
    "reservations": raw_reservations,
    "payments": raw_payments,
}


def raw_entities(t: Tables) -> dict[str, DataFrame]:
    return {name: build(t) for name, build in RAW_BUILDERS.items()}


def _in_arrival_order(t: Tables, name: str, df: DataFrame) -> DataFrame:
    """``df`` sorted by ``_seq``.  A payment is made of one line alone and a reservation of one booking, so these are sorted by the
    same values before any text is made of them: the sort moves numbers instead of texts."""
    if name == "reservations":
        return _reservations_of(_bookings(t).orderBy("_seq"))
    if name == "payments":
        return _payments_of(t["lineitem"].orderBy(*PAYMENT_ORDER))
    return df.orderBy("_seq")


def write_raw_extracts(t: Tables, raw_dir: str) -> dict[str, int]:
    """Write the derived raw extracts as compressed CSV folders (one per table), in arrival order.

    Rows are range-partitioned and sorted by ``_seq`` so part-file names and
    line positions reproduce the arrival order that ``read_raw_csv`` records.
    """
    from innflow.sources.files import write_csv

    counts = {}
    for name, df in raw_entities(t).items():
        ordered = _in_arrival_order(t, name, df).select(*RAW_COLUMNS[name])
        write_csv(ordered, f"{raw_dir}/{name}")
        counts[name] = t.spark.read.options(header="true", multiLine="true", escape='"').csv(
            f"{raw_dir}/{name}").count()
    return counts


def write_uneven_rooms(rooms: DataFrame, path: str) -> None:
    """The rooms extract as CSV in which every seventh row has a field too many and another seventh lacks its last one."""
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in RAW_COLUMNS["rooms"]]
    place = F.pmod("_seq", F.lit(7))
    line = (F.when(place == 3, F.concat_ws(",", *quoted, F.lit('"late"')))
            .when(place == 5, F.concat_ws(",", *quoted[:-1]))
            .otherwise(F.concat_ws(",", *quoted)))
    lines = rooms.orderBy("_seq").select(line.alias(",".join(RAW_COLUMNS["rooms"])))
    # one column whose separator never occurs: Spark writes the lines as they are, a header in every part file
    lines.write.mode("overwrite").options(header="true", sep="\u0001", quote="", escape="").csv(path)
