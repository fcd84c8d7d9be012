"""Library schema: one StructType per table, keys, foreign keys, allowed
values and column defaults. Constraints that stock Parquet tables cannot
enforce become data-quality rules (``shelfwise.operators.quality``)."""

from __future__ import annotations

from pyspark.sql import types as T

_I = T.IntegerType()
_S = T.StringType()
_D = T.DateType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


AUTHORS = T.StructType([
    _f("author_id", _I, False), _f("author_name", _S, False),
    _f("birth_year", _I), _f("country", _S)])

MEMBERS = T.StructType([
    _f("member_id", _I, False), _f("first_name", _S, False), _f("last_name", _S, False),
    _f("email", _S, False), _f("phone", _S), _f("address", _S), _f("join_date", _D),
    _f("membership_type", _S), _f("status", _S)])

EVENTS = T.StructType([
    _f("event_id", _I, False), _f("event_name", _S, False), _f("event_date", _D, False),
    _f("event_type", _S, False), _f("max_attendees", _I), _f("description", _S)])

AUDIT_LOG = T.StructType([
    _f("log_id", _I, False), _f("table_name", _S), _f("action", _S), _f("record_id", _I),
    _f("changed_at", T.TimestampType()), _f("changed_by", _S), _f("description", _S)])

BOOKS = T.StructType([
    _f("book_id", _I, False), _f("title", _S, False), _f("author_id", _I, False),
    _f("isbn", _S, False), _f("publication_year", _I), _f("genre", _S, False),
    _f("total_copies", _I)])

BOOK_COPIES = T.StructType([
    _f("copy_id", _I, False), _f("book_id", _I, False), _f("copy_number", _I, False),
    _f("condition", _S), _f("acquisition_date", _D)])

LOANS = T.StructType([
    _f("loan_id", _I, False), _f("member_id", _I, False), _f("copy_id", _I, False),
    _f("loan_date", _D, False), _f("due_date", _D, False), _f("return_date", _D),
    _f("status", _S)])

FINES = T.StructType([
    _f("fine_id", _I, False), _f("loan_id", _I, False),
    _f("fine_amount", T.DecimalType(10, 2), False), _f("fine_reason", _S, False),
    _f("paid", T.BooleanType()), _f("payment_date", _D)])

EVENT_REGISTRATIONS = T.StructType([
    _f("registration_id", _I, False), _f("event_id", _I, False),
    _f("member_id", _I, False), _f("registration_date", _D)])

SCHEMAS = {
    "authors": AUTHORS, "members": MEMBERS, "events": EVENTS, "audit_log": AUDIT_LOG,
    "books": BOOKS, "book_copies": BOOK_COPIES, "loans": LOANS, "fines": FINES,
    "event_registrations": EVENT_REGISTRATIONS,
}

# Tables in dependency order (parents first).
TABLE_ORDER = ["authors", "members", "events", "audit_log", "books", "book_copies",
               "loans", "fines", "event_registrations"]

PRIMARY_KEYS = {
    "authors": ["author_id"], "members": ["member_id"], "events": ["event_id"],
    "audit_log": ["log_id"], "books": ["book_id"], "book_copies": ["copy_id"],
    "loans": ["loan_id"], "fines": ["fine_id"], "event_registrations": ["registration_id"],
}

UNIQUE_KEYS = {
    "members": [["email"]], "books": [["isbn"]],
    "event_registrations": [["event_id", "member_id"]],
}

# (child, child column, parent, parent column, on delete)
FOREIGN_KEYS = [
    ("books", "author_id", "authors", "author_id", "restrict"),
    ("book_copies", "book_id", "books", "book_id", "cascade"),
    ("loans", "member_id", "members", "member_id", "restrict"),
    ("loans", "copy_id", "book_copies", "copy_id", "restrict"),
    ("fines", "loan_id", "loans", "loan_id", "cascade"),
    ("event_registrations", "event_id", "events", "event_id", "cascade"),
    ("event_registrations", "member_id", "members", "member_id", "cascade"),
]

# Allowed values of the enumerated columns, in declared order.
ALLOWED_VALUES = {
    ("members", "membership_type"): ["standard", "premium", "student"],
    ("members", "status"): ["active", "suspended", "expired"],
    ("events", "event_type"): ["book_club", "workshop", "reading_program", "author_visit"],
    ("audit_log", "action"): ["INSERT", "UPDATE", "DELETE"],
    ("book_copies", "condition"): ["excellent", "good", "fair", "poor"],
    ("loans", "status"): ["active", "returned", "lost"],
    ("fines", "fine_reason"): ["overdue", "damage", "lost"],
}

# Declared maximum string lengths.
MAX_LENGTHS = {
    ("authors", "author_name"): 100, ("authors", "country"): 50,
    ("members", "first_name"): 50, ("members", "last_name"): 50,
    ("members", "email"): 100, ("members", "phone"): 20, ("members", "address"): 200,
    ("events", "event_name"): 100, ("audit_log", "table_name"): 50,
    ("audit_log", "changed_by"): 50, ("books", "title"): 200, ("books", "isbn"): 20,
    ("books", "genre"): 50,
}

# CHECK constraints as SQL expressions (NULL passes, as in SQL).
CHECKS = {
    "books": ["total_copies > 0"],
    "fines": ["fine_amount >= 0"],
}

# Column defaults applied when a column is omitted on append. The value
# "as_of" stands for the load date, "as_of_ts" for the load timestamp.
DEFAULTS = {
    "members": {"join_date": "as_of", "membership_type": "standard", "status": "active"},
    "audit_log": {"changed_at": "as_of_ts", "changed_by": "SYSTEM"},
    "books": {"total_copies": 1},
    "book_copies": {"condition": "good"},
    "loans": {"status": "active"},
    "fines": {"paid": False},
    "event_registrations": {"registration_date": "as_of"},
}

# Driver tables (TPC-H-like); timestamps are read as TIMESTAMP_NTZ.
DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations"]
