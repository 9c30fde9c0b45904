import hashlib
import itertools
import random
import re
import zlib

import pytest

from costbook.llm import repair
from costbook.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"
RESULT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        by = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if by == 0:
            continue
        if by == 1:
            text = ""
        if by == 2:
            text = re.sub("[.!?]", "", text)
        if by == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if by == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        plain = text.strip(SPACES)
        fault = "blank" if not plain else "duplicate" if (role, text) in seen else "truncated" if plain[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, marks):
    """(cost, audit, messages) by a search over all edits, row by row and state by state."""
    insert = {0: [("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}
    move = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    names = {"u": "user", "a": "assistant"}
    best = {0: (0, "", ())}

    def closed(best):
        out = dict(best)
        for p, (cost, audit, said) in best.items():
            for _ in range(3):
                letter, p = insert[p][0]
                cost, audit, said = cost + 5, audit + "I", said + ((names[letter], ""),)
                if p not in out or (cost, audit) < out[p][:2]:
                    out[p] = (cost, audit, said)
        return out

    best = closed(best)
    for (_, _, role, text), fault in zip(rows, marks):
        new = {}

        def offer(q, cost, audit, said):
            if q not in new or (cost, audit) < new[q][:2]:
                new[q] = (cost, audit, said)

        for p, (cost, audit, said) in best.items():
            offer(p, cost + 2, audit + "D", said)
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if (p, role[:1]) in move:
                    offer(move[p, role[:1]], cost + extra, audit + "K", said + ((role, text),))
                for letter, name in names.items():
                    if (p, letter) in move:
                        offer(move[p, letter], cost + 1 + extra, audit + "R", said + ((name, text),))
        best = closed(new)
    return min((best[q] for q in (0, 3) if q in best), key=lambda x: x[:2])


def brute(rows, hurt=True):
    out = []
    ids = {r[0] for r in rows}
    kept = damage(rows) if hurt else [(c, t, *(" " if x is None else x for x in (r, s))) for c, t, r, s in rows]
    for conv in ids:
        own = sorted((r for r in kept if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        marks = faults(own)
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, said = cheapest(own, marks)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out.append((conv, gaps, *(marks.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def found(df):
    return sorted((tuple(r[c] for c in RESULT) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "agent"])
            text = rng.choice(["Yes.", "No!", "cut", "", " \n", None, "Why? ", "Yes.", f"n{rng.randrange(30)}."])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn - 1]), role, text))
    rng.shuffle(rows)
    return rows


def test_one_cut_a_span_equals_full_cyk():
    """The least over all cuts of every span is what the one cut gives."""
    rng = random.Random(1)
    g = repair.GRAMMAR
    for _ in range(40):
        row = [g.cell(rng.choice("suat"), rng.choice(["", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randrange(1, 8))]
        cells = {(i, i + 1): c for i, c in enumerate(row)}
        for size in range(2, len(row) + 1):
            for i in range(len(row) - size + 1):
                offers = [g.combine(cells[i, k], cells[k, i + size]) for k in range(i + 1, i + size)]
                cells[i, i + size] = [min((o[x] for o in offers if o[x] is not None), default=None) for x in range(len(g.pairs))]
                assert all(o == cells[i, i + size] for o in offers)


def test_audits_equal_every_edit_of_short_conversations():
    """Against all edit sequences with up to three insertions, the language checked by its pattern."""
    rng = random.Random(2)
    for _ in range(25):
        rows = [(1, k, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", f"c{k}.", ""])) for k in range(rng.randrange(0, 4))]
        marks = faults(rows)
        best = None
        options = []
        for r, m in zip(rows, marks):
            extra = 5 if m == "truncated" else 0
            options.append([(2, "D", "")] + ([] if m in ("blank", "duplicate") else [
                (extra, "K", r[2][:1]), (1 + extra, "R", "u"), (1 + extra, "R", "a")]))
        for edits in itertools.product(*options):
            for places in itertools.product(*[[(), ("u",), ("a",), ("u", "a"), ("a", "u")]] * (len(rows) + 1)):
                seq = [(5, "I", x) for x in places[0]]
                for e, p in zip(edits, places[1:]):
                    seq += [e, *[(5, "I", x) for x in p]]
                if re.fullmatch("(s?(ua)+)?", "".join(x for _, _, x in seq)):
                    got = (sum(c for c, _, _ in seq), "".join(a for _, a, _ in seq))
                    best = got if best is None or got < best else best
        assert cheapest(rows, marks)[:2] == best


@pytest.mark.parametrize("n,longest,parts,joined", [(60, 9, 7, 64), (3, 120, 40, 2)])
def test_equals_brute_force(spark, monkeypatch, n, longest, parts, joined):
    monkeypatch.setattr(repair, "JOINED", joined)
    rows = conversations(n, n, longest) + [(None, t, "user", f"t{t}.") for t in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert found(repair.repaired_conversations(df)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)


def test_messages_spell_the_language(spark):
    rows = conversations(9, 25, 12)
    done = repair.repair(spark.createDataFrame(rows, SCHEMA))
    said = {}
    for r in sorted(done.messages().collect(), key=lambda r: r["place"]):
        said.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    shas = {r["conv_id"]: r["repaired_sha256"] for r in done.digests().collect()}
    for conv, *_, sha in brute(rows, hurt=False):
        own = said.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in own))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in own).encode()).hexdigest() == sha == shas[conv]


def test_query_on_its_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op13_conversation_repair"](spark, sf)) == brute(rows)


def test_odd_rows_extra_columns_and_empty_table(spark):
    rows = [(1, None, None, None), (1, None, None, None), (None, None, "user", "x" * 100000), (2, 5, "", "a."), (3, 3, "user", "é.　"),
            (4, -9, "system", "s."), (4, 9, "assistant", "t.")] + [(5, 1, "user", "same.")] * 40
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("conv", "pos", "part", "mark", "at", "later", "fault", "rows", "cost", "audit", "_id", "by", "spans", "since"):
        df = df.selectExpr("*", f"'x' AS {c}")
    assert found(repair.repaired_conversations(df)) == brute(rows)
    assert repair.repaired_conversations(df.limit(0)).count() == 0
