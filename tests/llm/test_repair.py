"""Conversation repair against a search over all edit sequences."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidewise.llm import repair
from tidewise.llm.queries import QUERIES

GRAMMAR = re.compile("(s?(ua)+)?")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def faults(rows: list[tuple[str, str]]) -> list[str]:
    out, seen = [], set()
    for role, text in rows:
        rest = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def searched(rows: list[tuple[str, str]]) -> tuple[int, str, list[tuple[str, str]]]:
    """Cheapest edits in order of (cost, audit): a uniform-cost search that writes out every sequence of edits."""
    found = faults(rows)
    queue, number = [(0, "", 0, [])], itertools.count()
    queue = [(0, "", next(number), 0, [])]
    done = set()
    while True:
        cost, audit, _, at, out = heapq.heappop(queue)
        initials = "".join(role[:1] or "?" for role, _ in out)
        if at == len(rows) and GRAMMAR.fullmatch(initials):
            return cost, audit, out
        key = (at, "s" if initials == "s" else initials[-1:])
        if (key, cost, audit) in done or not re.fullmatch("(s?(ua)*u?)?", initials):
            continue
        done.add((key, cost, audit))
        ways = [(repair.INSERT, "I", at, (role, "")) for role in ("user", "assistant")]
        if at < len(rows):
            role, text = rows[at]
            ways.append((repair.DELETE, "D", at + 1, None))
            if found[at] not in ("blank", "duplicate"):
                stays = repair.STAYS_TRUNCATED if found[at] == "truncated" else 0
                ways.append((stays, "K", at + 1, (role, text)))
                ways += [(repair.REROLE + stays, "R", at + 1, (new, text)) for new in ("user", "assistant")]
        for price, edit, then, row in ways:
            heapq.heappush(queue, (cost + price, audit + edit, next(number), then, out + ([row] if row else [])))


def plain(rows: list[tuple]) -> dict:
    """The result for (id, turn, role, text, copies)."""
    convs = defaultdict(list)
    for conv, turn, role, text, copies in rows:
        convs[conv].extend([(turn, " " if role is None else role, " " if text is None else text)] * copies)
    out = {}
    for conv, those in convs.items():
        those.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in those if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        kinds = faults([r[1:] for r in those])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(those, those[1:]))
        cost, audit, kept = searched([r[1:] for r in those])
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[conv] = (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def damaged(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out.append((conv, turn, "user" if kind == 4 else role, text, 0 if kind == 0 else 2 if kind == 3 else 1))
    return out


def got(df) -> dict:
    rows = repair.repair_digests(df).collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in rows}


def conversations(n: int) -> list[tuple]:
    random.seed(n)
    texts = ["Yes.", "No!", "Why?", "cut", "", " \t\n", None, "é. \n", "\xa0", "Yes.", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "üser", "s"]
    rows = [(None, None, "user", "Hi."), (None, 3, "assistant", "Ho."), (-1, None, "tool", "Yes.")]
    for conv in range(n):
        for i in range(random.randint(1, 7)):
            copies = random.choice([1, 1, 1, 2])
            rows += [(conv, random.choice([i, i, i, 2 * i, None, 1]), random.choice(roles[: random.choice([3, 10])]), random.choice(texts))] * copies
    return rows


def test_audits_are_the_least_of_the_cheapest():
    """All conversations of up to five rows of the nine kinds, two block lengths."""
    kinds = [(r, t) for t in (".", "cut") for r in ("system", "user", "assistant", "tool")] + [("user", "")]
    small, usual = repair.Tables(2), repair.tables()
    assert len(usual.vectors) < 200
    for n in range(6):
        every = list(itertools.product(range(9), repeat=n))
        for symbols in random.Random(n).sample(every, min(len(every), 150)):
            # Texts differ, so that none is a duplicate; all of the last kind are blank.
            rows = [(kinds[k][0], f"{i}{kinds[k][1]}" if k < 8 else "") for i, k in enumerate(symbols)]
            cost, audit, _ = searched(rows)
            assert usual.audit(bytes(symbols)) == small.audit(bytes(symbols)) == (cost, audit), rows


def test_against_search(spark):
    rows = [(*r, c) for r, c in zip(conversations(60), itertools.cycle([1, 1, 2, 1, 0]))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, copies int, audit string, digest int")
    expected = plain(rows)
    found = got(repair.turns(df.repartition(5), copies="copies"))
    assert found == expected
    assert any(r[3] for r in found.values()) and any(r[0] for r in found.values())


def test_repaired_rows(spark):
    rows = [("a", 1, "user", "Hi."), ("a", 2, "user", "Hi."), ("a", 3, "user", "So?"), ("b", 1, "assistant", "no"), ("c", 0, "system", "Be."), ("c", 1, "tool", "X.")]
    df = repair.turns(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    out = sorted(tuple(r) for r in repair.repair(df, repair.report(df)).collect())
    assert out == [("a", 1, "K", "user", "Hi."), ("a", 2, "R", "assistant", "So?"), ("c", 1, "R", "user", "Be."), ("c", 2, "R", "assistant", "X.")]
    assert {r.conv_id: (r.cost, r.audit) for r in repair.report(df).collect()} == {"a": (3, "KDR"), "b": (2, "D"), "c": (2, "RR")}


def test_empty_and_long(spark):
    schema = "conv_id long, turn long, role string, text string"
    none = repair.repair_digests(repair.turns(spark.createDataFrame([], schema)))
    assert none.columns == [*COLUMNS, "repaired_sha256"] and none.count() == 0
    n = 5_000
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"{i}.") for i in range(n)] + [(2, 0, "user", "Same.")] * n
    found = got(repair.turns(spark.createDataFrame(rows, schema).repartition(4)))
    assert found[1][:7] == (0, 0, 0, 0, 0, 0, "K" * n)
    assert found[2][:7] == (0, 0, n - 1, 0, n - 1, 2 * n, "D" * n)


def test_query_against_search(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = plain(damaged(rows))
    found = {r.conv_id: tuple(r)[1:] for r in QUERIES["op13_repair"](spark, sf_dir).collect()}
    assert found == expected and len(found) == len({r[0] for r in rows})


@pytest.mark.parametrize("rows", [[(None, None, None, None)], [(7, 2, "user", None), (7, 2, None, "Hm.")]])
def test_query_reads_nulls_as_one_space(spark, tmp_path, rows):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: tuple(r)[1:] for r in QUERIES["op13_repair"](spark, str(tmp_path)).collect()}
    assert found == plain(damaged(rows))
