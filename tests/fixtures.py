"""A lending library for tests, drawn by a seeded generator from the schema's
rules; a few structural cases are added by name below. Nothing in the tests
relies on particular rows: expected results are worked out from the rows."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from shelfwise import schemas

AS_OF = dt.date(2001, 8, 2)
EVENTS_FROM = dt.date(2024, 1, 15)

N_AUTHORS, N_MEMBERS, N_BOOKS, N_LOANS, N_EVENTS = 14, 40, 32, 140, 14
#: members and books from these ids on are never part of a loan
IDLE_MEMBER, IDLE_BOOK = 38, 28
GENRES = ("PROMO", "STANDARD", "ECONOMY", "LARGE", "SMALL")


def _word(rng: random.Random) -> str:
    return "".join(rng.choice(("ba", "de", "ki", "lo", "mu", "ra", "si", "to")) for _ in range(rng.randint(2, 4))).capitalize()


def library_rows(seed: int = 11) -> dict[str, list[tuple]]:
    rng = random.Random(seed)
    day = lambda back: AS_OF - dt.timedelta(days=back)
    authors = [(i, _word(rng), rng.randint(1800, 1980), rng.choice(("Norland", "Sudland", "Estland"))) for i in range(1, N_AUTHORS + 1)]
    addresses = [f"{_word(rng)} {n}" for n in range(25)]
    members = []
    for i in range(1, N_MEMBERS + 1):
        members.append((i, _word(rng), _word(rng), f"m{i}@example.org", None if rng.random() < 0.2 else f"0-{i:04d}",
                        None if rng.random() < 0.1 else rng.choice(addresses), None if i == 7 else day(rng.randint(0, 700)),
                        rng.choice(("standard", "premium", "student")), rng.choices(("active", "suspended", "expired"), (7, 2, 1))[0]))
    # the last author has no book; two books share a title
    books = [(i, _word(rng) if i != 2 else None, rng.randint(1, N_AUTHORS - 1), f"isbn-{i}", rng.randint(1990, 2005), rng.choice(GENRES), rng.randint(1, 4))
             for i in range(1, N_BOOKS + 1)]
    books[1] = (2, books[0][1], *books[1][2:])
    copies, n = [], 0
    for b in books:
        for k in range(1, b[6] + 1):
            n += 1
            copies.append((n, b[0], k, rng.choice(("excellent", "good", "fair", "poor")), day(rng.randint(500, 3000))))
    lendable = [c[0] for c in copies if c[1] < IDLE_BOOK]
    loans, out_now = [], set()
    for i in range(1, N_LOANS + 1):
        copy, start = rng.choice(lendable), rng.randint(1, 420)
        status = rng.choices(("returned", "active", "lost"), (6, 4, 1))[0]
        if status == "active" and copy in out_now:
            status = "returned"
        if status == "active":
            out_now.add(copy)
        back = min(start, rng.randint(1, 40))
        loans.append((i, rng.randrange(1, IDLE_MEMBER), copy, day(start), day(start - 14), day(start - back) if status == "returned" else None, status))
    fines = []
    for loan in loans:
        late = (loan[5] - loan[4]).days if loan[5] else 0
        if loan[6] == "lost" or (late > 0 and rng.random() < 0.6):
            paid = rng.random() < 0.4
            amount = Decimal(late) * Decimal("0.25") if late > 0 else Decimal("20.00")
            for _ in range(1 + (rng.random() < 0.1)):  # now and then two fines on one loan
                fines.append((len(fines) + 1, loan[0], amount.quantize(Decimal("0.01")), "lost" if loan[6] == "lost" else "overdue", paid,
                              loan[4] + dt.timedelta(days=rng.randint(1, 20)) if paid else None))
    events = [(i, f"{_word(rng)} evening", EVENTS_FROM + dt.timedelta(days=rng.randint(-20, 45)),
               ("book_club", "workshop", "reading_program", "author_visit")[i % 4], 0 if i == 5 else rng.randint(5, 40), None) for i in range(1, N_EVENTS + 1)]
    # member 1 attends every book club
    pairs = {(e[0], 1) for e in events if e[3] == "book_club"}
    while len(pairs) < 60:
        pairs.add((rng.randrange(1, N_EVENTS), rng.randint(1, N_MEMBERS)))
    regs = [(i, e, m, EVENTS_FROM - dt.timedelta(days=rng.randint(1, 30))) for i, (e, m) in enumerate(sorted(pairs), 1)]
    at = dt.datetime.combine(AS_OF, dt.time(9))
    audit = [(i, "loans", "INSERT", i, at, "SYSTEM", "entry") for i in range(1, 4)]
    return {"authors": authors, "members": members, "events": events, "audit_log": audit, "books": books, "book_copies": copies,
            "loans": loans, "fines": fines, "event_registrations": regs}


def library_tables(spark: SparkSession, rows: dict | None = None) -> dict[str, DataFrame]:
    rows = rows or library_rows()
    return {name: spark.createDataFrame(rows[name], schemas.SCHEMAS[name]) for name in schemas.TABLE_ORDER}
