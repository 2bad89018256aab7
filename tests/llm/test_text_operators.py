"""Line dedup, repeats, near duplicates and decontamination against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pactline.llm import decontamination, linededup, neardup, repeats
from tests.llm.helpers import PASSAGE, awkward_docs, empty_docs, texts_of


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_lines_against_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choices("abc ", k=rng.choice([16, 17, 31, 32, 33, 47, 48, 64, 65, 100]))) for _ in range(12)]
    docs = []
    for doc in range(40):
        lines = []
        for _ in range(4):
            line, at = rng.choice(base), rng.randrange(16)
            kind = rng.randrange(5)
            lines.append({0: line, 1: line[:at] + "Z" + line[at + 1:], 2: line[:at] + line[at + 1:], 3: line[:at] + "Q" + line[at:], 4: line + "!"}[kind])
        docs.append((doc, "\n".join(lines)))
    got = {r["doc_id"]: (r["n_removed"], r["text"]) for r in linededup.op1_lines(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    seen = []
    for doc, text in docs:
        kept = []
        for line in text.split("\n"):
            gone = len(line) >= linededup.MIN_CHARS and any(near(line, other) for other in seen)
            if len(line) >= linededup.MIN_CHARS:
                seen.append(line)
            if not gone:
                kept.append(line)
        assert got[doc] == (4 - len(kept), "\n".join(kept))


def test_short_lines_by_equality(spark):
    long = "a line that is long enough"
    docs = [(1, "Read more\n\nx"), (2, f"Read more\nRead mord\n\nx\n{long}"), (3, f"{long}s\nShare this\nRead more\nRead more"), (4, "Read more")]
    got = {r["doc_id"]: (r["n_removed"], r["text"]) for r in linededup.dedup_lines(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: (0, "Read more\n\nx"), 2: (2, f"Read mord\n\n{long}"), 3: (3, "Share this"), 4: (1, "")}


def test_lines_awkward(spark):
    docs, rows = awkward_docs(spark)
    out = linededup.dedup_lines(spark, docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    got = out.collect()
    assert len(got) == len(rows)
    assert all(r["text"] is None and r["n_lines"] == 0 for r in got if r["n_lines"] == 0)
    assert next(r for r in got if r["text"] and r["text"].startswith("a\nline"))["n_removed"] == 1
    assert linededup.dedup_lines(spark, empty_docs(spark)).count() == 0


def repeats_brute(rows, length):
    starts = Counter(t[i: i + length] for t in (x.encode() for _, x in rows) for i in range(len(t) - length + 1))
    out = []
    for d, x in rows:
        t = x.encode()
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if starts[t[i: i + length]] > 1:
                gone[i: i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


def test_repeats_against_brute_force(spark):
    docs, rows = awkward_docs(spark, 1)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = sorted((tuple(r) for r in repeats.op8_repeats(spark, docs).collect()), key=key)
    assert got == sorted(repeats_brute(texts_of(rows), 200), key=key)
    assert repeats.op8_repeats(spark, empty_docs(spark)).count() == 0


def shingle_set(text, size):
    words = text.encode().lower().split()
    return frozenset(tuple(words[i: i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


@pytest.mark.parametrize("seed", [0, 1])
def test_neardup_against_brute_force(spark, seed):
    rng = random.Random(seed)
    docs = []
    for family in range(6):
        base = [f"t{family}x{rng.randrange(400)}" for _ in range(80)]
        for _ in range(8):
            own = list(base)
            for _ in range(rng.randrange(0, 5)):
                own[rng.randrange(80)] = f"new{rng.randrange(10 ** 6)}"
            docs.append((len(docs), " ".join(own)))
    docs += [(len(docs), ""), (len(docs) + 1, None), (len(docs) + 2, "One two"), (len(docs) + 3, "one TWO")]
    sets = {d: shingle_set(t or "", 4) for d, t in docs}
    root = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    got = neardup.op9_neardup(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {d: (len(sets[d]), root[d], root[d] == d) for d in sets}


def test_neardup_awkward(spark):
    docs, rows = awkward_docs(spark)
    assert neardup.op9_neardup(spark, docs).count() == len(rows)
    kept = neardup.keep_one(spark, docs)
    assert kept.columns == docs.columns
    texts = Counter(r["text"] for r in kept.collect())
    # one row for each text with words; texts without words stay under each of their ids
    assert all(n == 1 for t, n in texts.items() if t and t.split())
    assert "another text under the same id" in texts
    assert neardup.keep_one(spark, empty_docs(spark)).count() == 0


def test_decontamination(spark, monkeypatch):
    docs, rows = awkward_docs(spark)
    items = [(1, PASSAGE), (1, PASSAGE), (2, "w1 w2"), (3, None), (4, ""), (None, PASSAGE), (10, "Front, passage0!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: t.encode().translate(decontamination.ALNUM_LOWER).split()
    expected = []
    for d, t in texts_of(rows):
        own, hit, found = words(t), set(), set()
        for item, text in items:
            w = words(text or "")
            if item is None or not w:
                continue
            n = min(13, len(w))
            for window in (w[i: i + n] for i in range(len(w) - n + 1)):
                for at in range(len(own) - n + 1):
                    if own[at: at + n] == window:
                        hit.update(range(at, at + n))
                        found.add(str(item))
        expected.append((d, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(own)))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = [tuple(r) for r in decontamination.op10_contamination(spark, docs, bench).collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)
    # a bitmap that lets every shingle pass gives the same
    monkeypatch.setattr(decontamination, "held", lambda bits, slots, hashes: np.ones(len(hashes), bool))
    every = decontamination.find_contamination(spark, docs, bench)
    assert sorted(r["n_hit"] for r in every.collect()) == sorted(e[2] for e in expected)
    monkeypatch.undo()
    assert decontamination.drop_contaminated(spark, docs, bench).columns == docs.columns
    assert decontamination.op10_contamination(spark, empty_docs(spark), bench).count() == 0
    assert decontamination.op10_contamination(spark, docs, bench.limit(0)).where("contaminated").count() == 0


def test_differing_bits_never_exceed_differing_shingles(spark):
    """Also for bitmaps of different lengths, where the longer one is folded."""
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(60):
        base = rng.integers(0, 1 << 63, int(rng.integers(1, 700)), dtype=np.uint64)
        other = np.concatenate([base[int(rng.integers(0, len(base))):], rng.integers(0, 1 << 63, int(rng.integers(0, 300)), dtype=np.uint64)])
        a, b = np.unique(base), np.unique(other)
        rows.append((neardup.parities(a).tolist(), neardup.parities(b).tolist(), len(np.setxor1d(a, b))))
    rows.append((neardup.parities(base).tolist(), neardup.parities(base).tolist(), 0))
    found = spark.createDataFrame(rows, "a array<long>, b array<long>, d long").selectExpr("d", f"{neardup.differing_bits('a', 'b')} AS bits", "size(a) <> size(b) AS folded").collect()
    assert any(r.folded for r in found)
    assert all(r.bits <= r.d and (r.d - r.bits) % 2 == 0 for r in found)


def test_neardup_bitmap_test_stands_in_the_join(spark, monkeypatch):
    plans, columns = {}, {}
    real = neardup.stage

    def watched(session, df, label):
        plans.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString())
        columns.setdefault(label, df.columns)
        return real(session, df, label)

    monkeypatch.setattr(neardup, "stage", watched)
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{text} end{i}") for i in range(6)], "doc_id long, text string")
    assert {r["component_id"] for r in neardup.op9_neardup(spark, docs).collect()} == {0}
    lines = [x for x in plans["pairs"].splitlines() if "zip_with" in x]
    assert lines and all(x.lstrip(" :+-").startswith("Join") for x in lines)
    assert columns["ranks"] == columns["open"][:-1] == ["band", "node", "n", "rank"]
