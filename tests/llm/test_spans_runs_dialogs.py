"""Seed and extend, runs and conversation repair against brute force, with the defined edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skuflow.llm import dialogs, periodic, queries, seedextend

SCHEMA = "doc_id bigint, text string, row string, n bigint, core string, windows int, runs int, of int"


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, passages in other surroundings, periodic texts, nulls, empties, one long text; ids with a gap, one null."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 3)))
    prose = lambda n: [word() for _ in range(n)]
    base = [prose(rng.randint(25, 120)) for _ in range(12)]
    passage = prose(40)
    texts = [" ".join(b) for b in base] + [" \n ".join(b) for b in base[:4]]
    texts += [" ".join(w if i % 30 != 17 else "changed" for i, w in enumerate(b)) for b in base[:6]]
    texts += [" ".join(prose(5) + passage[k:k + 30] + prose(5)) for k in range(8)] + [" ".join(passage + prose(3) + passage)]
    texts += [" ".join(base[0][:19]), " ".join(base[0][:20]), None, "", " \t\x0b", "one", "x " * 70, "é ê " * 40, " ".join(base[5] * 6), "a b c " * 9 + "a a " * 9 + "a b c " * 9]
    texts += [" ".join(prose(6000) + base[7] * 5 + passage)]
    out = [(3 * i, t) for i, t in enumerate(texts)]
    rng.shuffle(out)
    return [*out, (None, " ".join(base[9])), out[0], (-4, " ".join(base[2]))]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2, 3, 4) for i, t in rows], SCHEMA).repartition(3)


def test_earlier_windows_are_removed(docs, rows):
    place = lambda i, s: (i is None, i or 0, s)
    least = {}
    for i, t in rows:
        w = split(t)
        for s in range(len(w) - 19):
            g = tuple(w[s:s + 20])
            least[g] = min(least.get(g, place(i, s)), place(i, s))
    wanted = []
    for i, t in rows:
        w = split(t)
        gone = {p for s in range(len(w) - 19) if least[tuple(w[s:s + 20])] < place(i, s) for p in range(s, s + 20)}
        wanted.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    assert sum(r[2] for r in wanted) > 500
    got = seedextend.remove_repeats(docs).collect()
    assert all(b["end"] - b["first"] >= 20 for r in got for b in r["spans"])
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r["doc_id"], r["n_words"], sum(s["end"] - s["first"] for s in r["spans"]), r["kept"]) for r in got), key=key) == sorted(wanted, key=key)


def test_other_lengths_and_empty_tables(spark, docs):
    some = seedextend.remove_repeats(docs, length=9, seed=4)
    assert some.where(F.size("spans") > 0).count() > 20
    assert seedextend.remove_repeats(docs.limit(0)).collect() == []
    assert periodic.find_runs(docs.limit(0)).collect() == []


def plain_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, q, length) for (s, length), q in found.items())


def test_runs_of_documents(docs, rows):
    got = {(r["doc_id"], r["n_words"], r["collapsed"], tuple((x["start"], x["period"], x["length"]) for x in r["runs"])) for r in periodic.find_runs(docs).collect()}
    wanted = set()
    for i, t in rows:
        w = split(t)
        own = plain_runs(w)
        gone = {p for s, q, length in own for p in range(s + q, s + length)}
        wanted.add((i, len(w), " ".join(x for p, x in enumerate(w) if p not in gone), tuple(own)))
    assert got == wanted
    assert sum(len(r[3]) > 0 for r in wanted) >= 4


def test_runs_of_random_texts():
    rng = random.Random(2)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 4)):
            part = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
            noise = [rng.choice("ab") for _ in range(rng.randint(0, 60))]
            texts.append((noise + part * rng.randint(0, 12) + noise[:9]) * rng.randint(0, 5))
        names = {}
        ids = np.array([names.setdefault((k, x), len(names)) for k, t in enumerate(texts) for x in t], np.int64)
        first = np.append(0, np.cumsum([len(t) for t in texts]))
        wanted = sorted((s + int(first[k]), q, s + length + int(first[k])) for k, t in enumerate(texts) for s, q, length in plain_runs(t))
        lo, hi, q = periodic.runs(ids, first)
        assert sorted(zip(lo.tolist(), q.tolist(), hi.tolist())) == wanted


def test_grammar_derives_the_text():
    """Each nonterminal derives one string wherever it is used, and no pair of symbols is left twice."""
    rng = random.Random(9)
    part = [rng.randint(0, 40) for _ in range(200)]
    ids = np.array(part * 7 + [rng.randint(0, 40) for _ in range(300)], np.int64)
    symbol, start, mid, end = periodic.re_pair(ids, np.arange(len(ids)), np.zeros(len(ids), np.int64))
    strings = {}
    for x, a, m, b in zip(*(v.tolist() for v in (symbol, start, mid, end))):
        assert strings.setdefault(x, (tuple(ids[a:b]), m - a)) == (tuple(ids[a:b]), m - a)
    assert len(strings) < len(symbol) / 2
    assert any(a == 0 and b == len(ids) for a, b in zip(start.tolist(), end.tolist()))


def test_looped_documents(docs, rows):
    got = {(r["doc_id"], tuple(split(r["text"]))) for r in queries.looped(docs).collect()}
    changed = 0
    for i, t in rows:
        w = split(t)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            changed += 1
        assert (i, tuple(w)) in got
    assert changed


def plain_repair(rows):
    """Counts, least (cost, audit) and repaired lines by dynamic programming."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, kinds, codes = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        codes.append(kind)
        if kind:
            kinds[kind] += 1
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    follows = (2, 2, 3, 2)
    name = {2: "user", 3: "assistant"}

    def inserted(best):
        for _ in range(3):
            for p, (cost, audit, lines) in list(best.items()):
                new = (cost + 2, audit + "I", [*lines, f"{name[follows[p]]}:"])
                best[follows[p]] = min(best.get(follows[p], new), new)
        return best

    best = {0: (0, "", [])}
    for (_, role, text), kind in zip(rows, codes):
        ahead = {}
        for p, (cost, audit, lines) in inserted(best).items():
            options = [(p, (cost + 3, audit + "D", lines))]
            if kind not in ("blank", "duplicate"):
                extra = kind == "truncated"
                options.append((follows[p], (cost + 2 + extra, audit + "R", [*lines, f"{name[follows[p]]}:{text}"])))
                to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(role[:1], {}).get(p)
                if to:
                    options.append((to, (cost + extra, audit + "K", [*lines, f"{role}:{text}"])))
            for to, new in options:
                ahead[to] = min(ahead.get(to, new), new)
        best = ahead
    best = inserted(best)
    cost, audit, lines = min(best[p] for p in (0, 3) if p in best)
    return gaps, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, cost, audit, "\n".join(lines)


CONV = "conv_id bigint, turn bigint, role string, text string, kind int, n int, c string, part int"


@pytest.fixture(scope="module")
def conversations():
    """Short ones with all faults, and one that holds a third of all rows."""
    rng = random.Random(8)
    out = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            out.append((conv, rng.choice([turn, turn, turn + 2, None]), role, rng.choice(["Yes.", "No", "", " \n", None, "Who? ", f"Text {turn}!", "é"])))
    for turn in range(400):
        out.append((1000, turn // 2, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"Turn {turn}.", f"Turn {turn}", ""])))
    return out + [(1000, 3, "user", "Same.")] * 300 + [(70, None, None, None)] * 2


def as_table(spark, rows):
    return spark.createDataFrame([(*r, 0, 1, "x", 2) for r in rows], CONV).repartition(5)


@pytest.fixture
def many_tasks(spark):
    """Small tables are dealt to many tasks too."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repairs_are_the_cheapest(spark, conversations, many_tasks):
    table = as_table(spark, conversations)
    report = dialogs.repair(table).cache()
    got = {r["conv_id"]: tuple(r)[1:] for r in report.collect()}
    lines = {}
    for r in dialogs.repaired_rows(table, report).collect():
        lines.setdefault(r["conv_id"], []).append((r["place"], f"{r['role']}:{r['text']}"))
    groups = {}
    for conv, turn, role, text in conversations:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert set(got) == set(groups)
    for conv, own in groups.items():
        *wanted, text = plain_repair(own)
        assert got[conv] == tuple(wanted), conv
        assert "\n".join(x for _, x in sorted(lines.get(conv, []))) == text


def test_blocks_of_one_conversation_come_from_several_tasks(spark, conversations, many_tasks):
    blocks = dialogs._blocks(dialogs._codes(as_table(spark, conversations)))
    hot = blocks.where("conv_id = 1000")
    assert hot.select("part").distinct().count() > 1 and hot.where("not whole").count() > 5


def test_damaged_conversations(spark, conversations):
    rows = [(c, t, r, x) for c, t, r, x in conversations if c != 1000] + [(c, t, "user", "Lost.") for c in range(200, 260) for t in range(1)]
    got = {r["conv_id"]: r for r in queries.repaired(as_table(spark, rows)).collect()}
    groups = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = groups.setdefault(conv, [])
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    assert any(not own for own in groups.values()) and set(got) == set(groups)
    for conv, own in groups.items():
        *wanted, text = plain_repair(own)
        assert tuple(got[conv])[1:] == (*wanted, hashlib.sha256(text.encode()).hexdigest()), conv


def test_empty_conversations(spark):
    assert queries.repaired(as_table(spark, [(1, 1, "user", "x")]).limit(0)).collect() == []


def test_search_against_all_edits():
    """Every edit sequence of short conversations, tried one by one."""
    rng = random.Random(3)

    def tries(codes, state, cost, audit):
        if state in (0, 3) and not codes:
            yield cost, audit
        if audit[-2:] != "II":
            yield from tries(codes, dialogs.FOLLOWS[state], cost + 2, audit + "I")
        if codes:
            c, rest = codes[0], codes[1:]
            yield from tries(rest, state, cost + 3, audit + "D")
            if c != "D":
                extra = int(c.isupper())
                yield from tries(rest, dialogs.FOLLOWS[state], cost + 2 + extra, audit + "R")
                follows, to = dialogs.KEEPS.get(c.lower(), ((), 0))
                if state in follows:
                    yield from tries(rest, to, cost + extra, audit + "K")

    for _ in range(60):
        codes = "".join(rng.choice("DsuaxSUAXua") for _ in range(rng.randint(0, 4)))
        assert dialogs.search(codes) == min(tries(codes, 0, 0, "")), codes
