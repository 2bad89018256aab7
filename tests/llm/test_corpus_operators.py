"""Fingerprints, pages, sharding, language model, packing, toxicity and the pipeline."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pactline.llm import fingerprints, html_extract, lm, packing, sharding, toxicity
from pactline.llm.elias_fano import EliasFano
from tests.llm.helpers import awkward_docs, empty_docs, texts_of


def test_fingerprints(spark):
    docs, rows = awkward_docs(spark)
    got = fingerprints.fingerprint_documents(spark, docs).collect()
    assert len(got) == len(rows)
    single = [(d, t) for d, t in texts_of(rows) if d is not None and d not in (5, 7)]
    single.sort()
    by_id = {r["doc_id"]: r for r in got}
    following = {d: t for (d, _), (_, t) in zip(single, single[1:], strict=False)}
    for d, t in single:
        assert by_id[d]["fingerprint"] == fingerprints.fingerprint_texts([t])[0]
        if d in following and d + 1 in by_id and d + 1 not in (5, 7):
            cut = len(t) // 2
            assert by_id[d]["edited_sha256"] == hashlib.sha256((t[: len(t) - cut] + following[d][:cut]).encode()).hexdigest()
    assert fingerprints.fingerprint_documents(spark, empty_docs(spark)).count() == 0


def test_fingerprints_resist_shifts():
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(2000))
    a, b = fingerprints.digests([text.encode(), ("shifted " + text).encode()])
    assert fingerprints.containment(a, b) > 0.95


PAGE = """<html><head><title>x</title></head><body><header><h1>Site</h1></header><nav><a href=1>menu</a></nav>
<div class="cookie-notice">We use cookies</div><main><article><header><h1>Ti&amp;tle</h1></header><p>One  <b>t</b>wo<br>three
 four</p><ul><li>a<li>b</ul><div class="ad">Buy!</div><p>End &lt;x&gt;<p>Last <!-- c --><script>var t="</p>"</script>word<form><input>q</form>
</article><section id="comments"><p>Nice post</p></section></main><aside>side</aside><footer>f</footer></body></html>"""


def test_pages(spark):
    plain = "<body><div class=top>Acme News</div><div class=text><p>Body number {0} of some length, told in full here.</p><p>More {0} words follow.</p></div><div class=low>All rights kept</div></body>"
    rows = [(1, "http://a.b/x", PAGE, 1), (1, "http://a.b/x", PAGE, 1), (2, None, None, 2), (3, "http://a.b", "", 3)]
    rows += [(10 + i, f"http://plain.org/{i}", plain.format(i), 0) for i in range(6)]
    got = html_extract.extract_pages(spark, spark.createDataFrame(rows, "page_id long, url string, html string, host int")).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert texts[1] == "Ti&tle\n\nOne two three four\n\na\n\nb\n\nEnd <x>\n\nLast word"
    assert texts[2] == texts[3] == ""
    assert texts[12] == "Body number 2 of some length, told in full here.\n\nMore 2 words follow."


def pages_of(spark, rows):
    rows = [(i, f"http://{host}/{i}", html) for i, (host, html) in enumerate(rows)]
    return {r["page_id"]: r["text"] for r in html_extract.extract_pages(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_template_text_inside_containers_goes(spark):
    page = "<html><body><article><h1>Title {0}</h1><p>Body number {0} is told here at some length.</p>{1}<div class=low>All rights kept</div><p>Tell your friends</p></article></body></html>"
    quote = "<p>A passage that some pages quote.</p><p>It has two paragraphs.</p><blockquote>And a quotation.</blockquote>"
    box = "<div class=box><p>Legal line of some pages</p></div>"
    got = pages_of(spark, [("a.org", page.format(i, quote if i % 2 else box)) for i in range(8)] + [("b.org", page.format(0, box).replace("0", "x" * i)) for i in range(2)])
    own = "Title {0}\n\nBody number {0} is told here at some length."
    assert got[4] == own.format(4)
    assert got[5] == own.format(5) + "\n\nA passage that some pages quote.\n\nIt has two paragraphs.\n\nAnd a quotation."
    assert "Tell your friends" in got[8]  # two pages have no template


def test_copies_of_one_article_stay(spark):
    page = "<body><nav>{0}</nav><article><h1>One title</h1><p>The same long article on every page of the host.</p><p>Edit {1}</p></article></body>"
    got = pages_of(spark, [("a.org", page.format(i, i % 2)) for i in range(4)] + [("b.org", page.format(i, 1)) for i in range(4)])
    assert all(t.startswith("One title\n\nThe same long article") for t in got.values())


def test_articles_in_parts(spark):
    lead = "<body><main><h1>Title</h1><p>Lead</p><article><p>Body text of the article, longer than its lead.</p></article></main></body>"
    split = "<body><div class=content><p>First part, which is the longer one.</p></div><div class=ad>Buy</div><div class=content><p>Second part</p><p><a href=x>A reference</a></p></div></body>"
    around = "<body><h1>Title</h1><p>Lead</p><div class=box>Elsewhere</div><article><p>Body</p></article></body>"
    sibling = "<body><div class=site>Acme News</div><div class=head><h1>Title {0}</h1></div><div class=text><p>Body number {0}, long enough.</p><p><a href=x>Reference {0}</a></p></div><div class=tops><a href=y>Other story {0}</a></div></body>"
    beside = "<body><div class=site>Acme News</div><div class=head><h1>Title {0}</h1></div><article><p>Body number {0}</p></article></body>"
    rows = [("a.org", lead), ("b.org", split), ("c.org", around), *(("d.org", sibling.format(i)) for i in range(4)), *(("e.org", beside.format(i)) for i in range(4))]
    got = pages_of(spark, rows)
    assert got[0] == "Title\n\nLead\n\nBody text of the article, longer than its lead."
    assert got[1] == "First part, which is the longer one.\n\nSecond part\n\nA reference"
    assert got[2] == "Title\n\nLead\n\nBody"
    assert got[4] == "Title 1\n\nBody number 1, long enough.\n\nReference 1"
    assert got[8] == "Title 1\n\nBody number 1"


def test_sharding(spark):
    docs, rows = awkward_docs(spark, n=400)
    got = sharding.op4_shards(spark, docs, 6).collect()
    assert len(got) == len(rows)
    sizes, slots = Counter(), {}
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    rest = [v for k, v in sizes.items()]
    assert sum(rest) == sum(len(t.encode()) + 8 for _, t in texts_of(rows))
    assert sharding.op4_shards(spark, empty_docs(spark)).count() == 0
    crcs = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    assert crcs == Counter((d, len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t in texts_of(rows))
    clash = docs.withColumns({c: F.lit(c) for c in ("_rank", "_part", "_base", "_key", "_doc", "row", "size")})
    kept = sharding.shard_rows(spark, clash, 4)
    assert sorted(kept.columns) == sorted({*clash.columns, "size", "shard", "slot"})
    assert all((r["_rank"], r["_part"], r["_base"], r["_key"], r["_doc"], r["row"]) == ("_rank", "_part", "_base", "_key", "_doc", "row") for r in kept.collect())


def test_shards_are_near_equal_and_keep_equal_texts_together(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("abcdef", k=rng.randint(5, 200)))) for i in range(3000)]
    rows += [(5000 + i, rows[i % 100][1]) for i in range(400)]  # groups of five, each under 5% of a shard
    shards, sizes = {}, Counter()
    for r in sharding.op4_shards(spark, spark.createDataFrame(rows, "doc_id long, text string"), 12).collect():
        shards.setdefault(r["text_crc32"], set()).add(r["shard"])
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) < 1.1 * min(sizes.values()) and len(sizes) == 12
    assert all(len(s) == 1 for s in shards.values())


def test_sharding_splits_a_hot_text(spark):
    rows = [(i, "the same text") for i in range(600)] + [(1000 + i, f"text {i}") for i in range(900)]
    sizes = Counter()
    for r in sharding.op4_shards(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect():
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 24 and max(sizes.values()) < 1.15 * min(sizes.values())


def test_packing(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs, rows = awkward_docs(spark)
    got = packing.pack_documents(spark, docs, with_ids=True).collect()
    sequences = {}
    pieces = Counter()
    expected = Counter()
    for _, t in texts_of(rows):
        ids = [*whole.encode(t, add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), 2048):
            part = ids[start: start + 2048]
            expected[start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)] += 1
    for r in got:
        pieces[r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces == expected
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    assert packing.op6_pack(spark, empty_docs(spark)).count() == 0


@pytest.mark.parametrize("text", ["a  b", " lead", "trail ", "x\n \ny", "<|endoftext|> z", "it's we'll", "日本 語 text", "tab\tand nbsp", "", "a \n b"])
def test_encoder_equals_tokenizer(text):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    ids = [*Tokenizer.from_file(P.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids, 1]
    assert packing.make_encoder()(text) == np.array(ids, "<u4").tobytes()


def test_plan_covers_the_histogram():
    rng = random.Random(5)
    histogram = Counter(rng.randint(1, 2048) for _ in range(30_000))
    used, padding = Counter(), 0
    for pattern, n in packing.plan(histogram):
        assert sum(pattern) <= 2048
        padding += n * (2048 - sum(pattern))
        for v in pattern:
            used[v] += n
    assert used == histogram and padding < 0.01 * sum(k * n for k, n in histogram.items())


def test_plan_of_few_lengths():
    assert packing.plan({600: 900, 700: 900, 748: 900}) == [((600, 700, 748), 900)]
    used, padding = Counter(), 0
    histogram = {600: 1000, 700: 1000, 748: 1000, 1000: 300, 1048: 300, 682: 200, 684: 100}
    for pattern, n in packing.plan(histogram):
        padding += n * (2048 - sum(pattern))
        for v in pattern:
            used[v] += n
    assert used == histogram and padding == 0


def test_every_exact_filling_is_a_combination():
    lengths = np.array(sorted(random.Random(4).sample(range(1, 97), 40)))
    every = {tuple(sorted((a, b, c))) for a in (0, *lengths) for b in (0, *lengths) for c in (0, *lengths) if a + b + c == 96}
    assert sorted(tuple(sorted(c)) for c in packing.combinations(lengths, 96).tolist()) == sorted(every)


@pytest.mark.parametrize("bound", [1, 50, 1 << 20, 1 << 63])
def test_elias_fano(bound):
    values = np.sort(np.random.default_rng(1).integers(0, bound, 3000).astype(np.uint64))
    packed = EliasFano(values, bound)
    assert (packed[np.arange(3000)] == values).all()
    probe = np.concatenate([values[::7], values[::11] + np.uint64(1)])
    at = packed.successor(np.zeros(len(probe), np.int64), np.full(len(probe), 3000), probe)
    assert (at == np.searchsorted(values, probe)).all()
    assert EliasFano(values[:0], 1).n == 0


def test_language_model(spark):
    docs, rows = awkward_docs(spark)
    got = lm.op5_lm(spark, docs).collect()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    texts = [(d, [*t.encode().lower().split(), 2]) for d, t in texts_of(rows)]
    uni, bi, ctx = Counter(), Counter(), Counter()
    for d, w in texts:
        if not held(d):
            uni.update(w)
            bi.update(zip([1, *w], w, strict=False))
            ctx.update([1, *w[:-1]])
    scale = sum(uni.values()) + 0.5 * (len(uni) + 1)
    p = lambda w: (uni[w] + 0.5) / scale
    expected = sorted((len(w), sum(uni[x] > 0 for x in w), round(sum(math.log10(p(x)) for x in w), 6),
                       sum(math.log10((bi[a, b] + lm.MU * p(b)) / (ctx[a] + lm.MU)) for a, b in zip([1, *w], w, strict=False))) for _, w in texts)
    mine = sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 6), r["score"]) for r in got)
    assert [x[:3] for x in mine] == [x[:3] for x in expected]
    assert all(abs(a[3] - b[3]) < 3e-4 * a[0] for a, b in zip(mine, expected, strict=True))
    assert {r["train_tokens"] for r in got} == {sum(uni.values())}
    assert lm.op5_lm(spark, empty_docs(spark)).count() == 0


def toxic_docs(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        words = [f"n{rng.randrange(200)}" for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(40)] = rng.choice(["idiot", "moron"])
        if i % 5 == 0:
            words[0] = rng.choice(["women", "muslims", "people"]) if not bad else "women"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int"), dict(labels)


def test_toxicity(spark):
    docs, labels, truth = toxic_docs(spark)
    got = toxicity.op7_toxicity(spark, docs, labels).collect()
    assert all(r["predicted"] == truth[r["doc_id"]] for r in got)
    model = toxicity.train(docs, labels)
    swapped = toxicity.score_texts(spark.createDataFrame([("a", "n1 women n2"), ("b", "n1 people n2"), ("c", "n1 n2")], "k string, text string"), model, ["k"])
    scores = {r["k"]: r["score"] for r in swapped.collect()}
    assert abs(scores["a"] - scores["b"]) < 0.02 and scores["a"] < toxicity.THRESHOLD


def test_toxicity_awkward(spark):
    docs, rows = awkward_docs(spark)
    _, labels, _ = toxic_docs(spark)
    out = toxicity.drop_toxic(spark, docs, labels)
    assert out.columns == docs.columns
    assert toxicity.op7_toxicity(spark, docs, labels).count() == len(rows)
    assert toxicity.op7_toxicity(spark, docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.op7_toxicity(spark, empty_docs(spark), labels).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = function(spark, docs, sf_dir)
        assert docs.columns == columns
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
