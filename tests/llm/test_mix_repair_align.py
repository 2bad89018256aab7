"""Mixing, conversation repair and tokenizer alignment against brute force, with awkward inputs."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pactline.llm import alignment, conversations, mixing
from tests.llm.helpers import awkward_docs, empty_docs

# -- mixing ---------------------------------------------------------------------


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def reshared(sizes, weights, total):
    """Targets by resharing: sources above twice their size stop there, the excess goes round again."""
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    left = total
    while open_ and left > 1e-9:
        unit = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if target[s] + unit * weights[s] > 2 * sizes[s]}
        if not over:
            for s in open_:
                target[s] += unit * weights[s]
            return target
        for s in over:
            left -= 2 * sizes[s] - target[s]
            target[s] = 2.0 * sizes[s]
        open_ -= over
    return target


def mix_docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, row int, size int, of string, copies int, `a.b` int")


@pytest.mark.parametrize("seed", range(3))
def test_targets_are_what_resharing_gives(spark, seed):
    rng = random.Random(seed)
    names = [None, "", "a", "A", "\U0001f600", "é", "zz", "z"][: rng.randint(3, 8)]
    rows = [(i, " \t".join(["w"] * rng.choice([0, 1, 5, 60])), rng.choice(names), 1, 2, "x", 3, 4) for i in range(200)]
    rows += [(200 + i, "w " * rng.randint(1, 2000), names[-1], 1, 2, "x", 3, 4) for i in range(5)]
    got = mixing.op11_mix(spark, mix_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s, *_ in rows:
        sizes[s] += words(t)
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    target = reshared(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    of = {r[0]: (r[1], r[2]) for r in rows}
    for r in got:
        text, source = of[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (words(text), sizes[source])
        assert r["target"] == pytest.approx(target[source])
        rate = target[source] / sizes[source] if sizes[source] else 0
        assert r["taken"] in {int(rate + 1e-9) * r["size"], min(2, int(rate + 1e-9) + 1) * r["size"]}


def test_copies_come_near_the_target_and_reruns_agree(spark):
    rows = [(i, "w " * (1 + i % 7), "hot" if i % 3 else f"s{i % 9}", 1, 2, "x", 3, 4) for i in range(6000)]
    docs = mix_docs(spark, rows)
    first = {r["doc_id"]: r["taken"] for r in mixing.op11_mix(spark, docs.repartition(7)).collect()}
    rows_got = mixing.op11_mix(spark, docs.coalesce(1)).collect()
    assert first == {r["doc_id"]: r["taken"] for r in rows_got}
    taken, target = Counter(), {}
    for r, (_, _, source, *_) in zip(sorted(rows_got, key=lambda r: r["doc_id"]), rows, strict=True):
        taken[source] += r["taken"]
        target[source] = r["target"]
    assert all(abs(taken[s] / target[s] - 1) < 0.1 for s in target)
    emitted = mixing.emit_copies(mixing.mix_documents(spark, docs))
    assert emitted.columns == docs.columns
    assert sum(words(r["text"]) for r in emitted.collect()) == sum(taken.values())


def test_mixing_awkward_documents(spark):
    docs, rows = awkward_docs(spark)
    got = mixing.op11_mix(spark, docs).collect()  # one source: null
    assert len(got) == len(rows) and {r["source_size"] for r in got} == {sum(words(t) for _, t in rows)}
    assert all(r["taken"] in (r["size"], 2 * r["size"]) for r in got)
    assert mixing.op11_mix(spark, empty_docs(spark)).count() == 0
    silent = mix_docs(spark, [(1, None, "a", 1, 2, "x", 3, 4), (2, " \n", "b", 1, 2, "x", 3, 4)])
    assert [(r["target"], r["taken"]) for r in mixing.op11_mix(spark, silent).collect()] == [(0.0, 0), (0.0, 0)]
    with pytest.raises(ValueError):
        mixing.mix_documents(spark, docs, share_percent=250)


# -- conversation repair --------------------------------------------------------

BLANK = " \t\n\v\f\r"
CONVERSATIONS = "conv_id long, turn long, role string, text string, gone int, later string"


def damaged(rows):
    out = []
    space = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        rule = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = "user" if rule == 4 else space(role), space(text)
        text = "" if rule == 1 else re.sub("[.!?]", "", text) if rule == 2 else text
        out += [(turn, role, text)] * (0 if rule == 0 else 2 if rule == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def repaired(rows):
    """Report of one conversation's rows (after damage, in order): edits tried in the order of (cost, audit)."""
    seen, kinds = set(), []
    for _, role, text in rows:
        end = text.rstrip(BLANK)
        kinds.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    heap = [(0, "", 0, "", ())]
    while True:
        cost, audit, at, initials, made = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            break
        steps = [(5, "I", at, r[0], ((r, ""),)) for r in ("user", "assistant")] if not audit.endswith("III") else []
        if at < len(rows):
            role, text = rows[at][1:]
            extra = 5 if kinds[at] == "truncated" else 0
            steps.append((2, "D", at + 1, "", ()))
            if kinds[at] in ("", "truncated"):
                steps += [(1 + extra, "R", at + 1, r[0], ((r, text),)) for r in ("user", "assistant")]
                steps += [(extra, "K", at + 1, role[0], ((role, text),))] if role else []
        for more, letter, to, initial, row in steps:
            if re.fullmatch("s?(ua)*u?", initials + initial):
                heapq.heappush(heap, (cost + more, audit + letter, to, initials + initial, made + row))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), made


def random_conversations(seed, n=250):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for t in range(rng.randint(1, 6)):
            turn = None if rng.random() < 0.1 else t + rng.randint(0, 1) - 1
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant", "User"]), rng.choice(["Hi.", "Yes!", "no", "  ", "", "ok.", None, "what?", "cut \n", "é.\xa0", "x\x1c"])))
    return rows


@pytest.mark.parametrize("held", [conversations.HELD_BYTES, 0])
def test_repairs_against_brute_force(spark, held):
    rows = random_conversations(4) + [(9000, 0, "user", "Same."), (9000, 0, "user", "Same."), (9000, 5, "user", "Same."), (9001, 3, "assistant", "x" * 40_000 + "."), (9001, 1, "user", "y" * 40_000 + "?")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], CONVERSATIONS)
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    report = conversations.repair_report(spark, conversations.damaged(df), held)
    got = {r[0]: tuple(r)[1:] for r in report.collect()}
    expected = {conv: repaired(damaged(own)) for conv, own in by.items()}
    assert got == {conv: e for conv, (e, _) in expected.items()}
    if held == 0:
        made = defaultdict(list)
        for r in conversations.repaired_rows(spark, conversations.damaged(df), report.select("conv_id", "audit")).orderBy("conv_id", "place").collect():
            made[r["conv_id"]].append((r["role"], r["text"]))
        assert {c: made.get(c, []) for c in expected} == {c: list(m) for c, (_, m) in expected.items()}


def test_no_rows_and_no_conversations(spark):
    # a conversation all of whose rows the damage drops
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 0, "user", "Hi.", 1, "z")], CONVERSATIONS)
    assert [tuple(r) for r in conversations.op12_repair(spark, df).collect()] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert conversations.op12_repair(spark, df.limit(0)).count() == 0


def test_weights_of_any_width_give_the_same_path(monkeypatch):
    for seed in range(200):
        rng = random.Random(seed)
        kinds = [rng.choice([0, 1, 2, 3, 5, 6, 7, 8, 2, 3]) for _ in range(rng.randint(1, 12))]
        results = []
        for width in (8, 16, 512):
            monkeypatch.setattr(conversations, "WIDTH", width)
            path = conversations.Path()
            for k in kinds:
                path.row(k)
            results.append(path.repair())
        assert results[0] == results[1] == results[2]


def test_long_conversations_keep_narrow_weights():
    rng = random.Random(1)
    path = conversations.Path()
    for _ in range(30_000):
        path.row(rng.choice([2, 3, 2, 3, 6, 7, 8, 1]))
    assert path.width <= 1024 and len(path.repair()[1]) >= 30_000


# -- alignment -------------------------------------------------------------------


def make_brute():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    names = {i: t for t, i in a.get_vocab().items()}
    printable = {chr(c): c for c in range(256) if 33 <= c < 127 or 161 <= c < 173 or 174 <= c}
    alphabet = {**printable, **{chr(256 + k): c for k, c in enumerate(c for c in range(256) if chr(c) not in printable)}}

    def align(text):
        """Two cursors over whole-text encodings; a group ends where both stand at one byte."""
        if not text:
            return None
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ba = [bytes(alphabet[c] for c in names[i]) for i in ia]
        bb = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ib)]
        if not b"".join(ba) == b"".join(bb) == (" " + text).encode():
            return None
        ends = sorted(set(np.cumsum([len(x) for x in ba])) & set(np.cumsum([len(x) for x in bb])))
        groups, at = [], [0, 0, 0, 0]
        for end in ends:
            side_a, side_b = [], []
            while at[1] < end:
                side_a.append(ia[at[0]])
                at[0], at[1] = at[0] + 1, at[1] + len(ba[at[0]])
            while at[3] < end:
                side_b.append(ib[at[2]])
                at[2], at[3] = at[2] + 1, at[3] + len(bb[at[2]])
            groups.append((side_a, side_b))
        return len(ia), len(ib), groups, Counter((x, y) for g, h in groups for x in g for y in h)

    return align


def odd_texts(seed, n):
    rng = random.Random(seed)
    parts = [" ", " ", "  ", "\n", "\t", "a", "Be", "the", "é", "中文", "'s", "12", "\x1c", "▁", "<s>", "<0x41>", "<|endoftext|>", "\U0001f600", "\r\n", "   ", "　", " ́", "\x00", "ſ", "½", " ", "word", "x" * 9]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_alignment_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 300)  # several blocks
    monkeypatch.setattr(alignment, "CACHE_SEGMENTS", 50)  # and a full segment table
    docs, rows = awkward_docs(spark)
    rows = [*rows, *enumerate(odd_texts(2, 300), 1000), (5000, "word " * 3000), (5001, "x" * 20_000)]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, block string, pairs int")
    align = make_brute()
    found = [align(t) for _, t in rows]
    count = Counter(p for f in found if f for p in f[3])
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    expected = []
    for (d, _), f in zip(rows, found, strict=True):
        if f is None:
            expected.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        expected.append((d, n_a, n_b, len(groups), sum(links.values()), sum(k for p, k in links.items() if count[p] == most[p[0]]),
                         sum(k * count[p] for p, k in links.items()), hashlib.sha256(text.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = [tuple(r) for r in alignment.align_documents(spark, docs).collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert sum(f is None for f in found) > 5
    assert alignment.align_documents(spark, empty_docs(spark)).count() == 0


def test_products_against_dense_matrices():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a = rng.integers(1, 5, rng.integers(1, 30))
        b = []
        while sum(b) < a.sum():
            b.append(int(min(rng.integers(1, 5), a.sum() - sum(b))))
        b = np.array(b)
        dense = [np.repeat(np.eye(len(x), dtype=int), x, axis=1) for x in (a, b)]
        overlaps = dense[0] @ dense[1].T
        i, j, shared = alignment.overlap_links(a, b)
        assert np.array_equal(overlaps[i, j], shared) and len(i) == np.count_nonzero(overlaps)
        of_a, of_b, la, lb = alignment.group_links(a, b)
        both = sorted(set(np.cumsum(a)) & set(np.cumsum(b)))
        assert np.array_equal(of_a, np.searchsorted(both, np.cumsum(a))) and np.array_equal(of_b, np.searchsorted(both, np.cumsum(b)))
        linked = of_a[:, None] == of_b[None, :]
        assert np.array_equal(np.argwhere(linked), np.stack([la, lb], 1))
