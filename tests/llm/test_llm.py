"""The training-data operators against brute force, exact round trips and held-out accuracy, and on odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexbrook.llm import bpe, components, decontaminate, html, langid, licenses, lmscore, pii, queries, simhash, spotsigs, toxicity
from lexbrook.llm.common import fold_crc, pieces, table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, id string, score double, carry string, h long"
#: Nulls in any column, empty and long texts, ties, repeated rows, columns with names that operators use.
ODD = [
    (1, "Der Hund ist nicht in dem Haus und die Katze auch nicht.", "de", "x", 0.5, "c", 7), (1, "Der Hund ist nicht in dem Haus und die Katze auch nicht.", "de", "x", 0.5, "c", 7), (2, None, None, None, None, None, None),
    (None, "the cat is on the mat and the dog is in the house", "en", None, None, None, None), (3, "", "de", None, None, None, None), (4, "wort " * 40_000, None, "x", 1.0, "c", 1), (5, " \n\t ", "en", None, None, None, None),
    (6, "🙂 \u0000 <b>&amp; ퟿", "de", None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SF, "documents")


def test_every_operator_takes_odd_and_empty_tables(spark, odd, nothing):
    items = spark.createDataFrame([(1, "the cat is on the mat and the dog is in the house"), (2, None), (3, "Der Hund")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    token = queries.tokenizer_file()
    runs = {
        "langid": lambda d: langid.identify(d, langid.train_dictionaries(d)), "html": lambda d: html.extract_main_text(d, "doc_id", "text", ["lang", "carry"]),
        "simhash": simhash.near_duplicates, "representatives": simhash.representatives, "toxicity": lambda d: toxicity.score(d, toxicity.train(d, labels), carry=["score", "carry"]),
        "lm": lambda d: lmscore.score(d, d), "decontaminate": lambda d: decontaminate.decontaminate(d, items, carry=["id", "carry"]), "licenses": licenses.scan,
        "spotsigs": spotsigs.edit_likeness, "bpe": lambda d: bpe.bpe_encode(d, token, decoded=True), "pii": lambda d: pii.pseudonymize(d, b"k", carry=["id", "carry"]),
    }
    for name, run in runs.items():
        n = len(run(odd).collect())
        assert n == (len(ODD) - 1 if name == "representatives" else len(ODD)) or name == "representatives" and n < len(ODD), name
        assert run(nothing).count() == 0, name
    no_items = items.limit(0)
    assert not any(r["contaminated"] for r in decontaminate.decontaminate(odd, no_items).collect())


def test_results_for_null_and_empty_texts(odd):
    lang = {r["doc_id"]: r for r in langid.identify(odd, {"de": b"der die das " * 50, "en": b"the of and " * 50}).collect()}
    assert lang[2]["lang"] == lang[3]["lang"] == lang[5]["lang"] == "und" and lang[2]["score"] == 0.0
    prints = {r["doc_id"]: r for r in simhash.near_duplicates(odd).collect()}
    assert prints[2]["fingerprint"] == "0" * 16 and prints[2]["component_id"] == prints[3]["component_id"] == prints[5]["component_id"] == 2
    coded = {r["doc_id"]: r for r in bpe.bpe_encode(odd, queries.tokenizer_file(), decoded=True).collect()}
    assert coded[2]["ids"] == [] and coded[3]["decoded"] == "" and coded[4]["decoded"] == "wort " * 40_000


def test_pieces_hold_all_rows():
    import pyarrow as pa

    b = pa.record_batch([pa.array(["a" * 10, None, "b" * 50, "", "c" * 10])], names=["t"])
    got = list(pieces(iter([b, b.slice(0, 0)]), "t", 20))
    assert [x for p in got for x in p.column(0).to_pylist()] == b.column(0).to_pylist() and len(got) == 3


# 1 language


def test_language_of_held_out_documents(spark, documents):
    got = queries.op1_langid(spark, SF).join(documents, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) >= 0.9 and all(0 <= r["score"] <= 1 for r in got)


# 2 pages


@pytest.mark.parametrize(
    "page, text",
    [
        ("<html><head><title>T</title></head><body><nav><a href=x>Home</a></nav><article><h1>A  B</h1><p>One &amp; two,<br>three.<p>Four &lt;5&gt;.</article><footer>f</footer>", "A B\nOne & two, three.\nFour <5>."),
        ("<body><div id=sidebar><p>Long side text, with commas, many, of them, really.</p></div><main><p>Main text, here, is long enough.</p><ul><li>Item one</li></ul></main>", "Main text, here, is long enough.\nItem one"),
        ("<article><p>Body text is here, truly.</p></article><div class='comments'><p>First! So good, so good, so good, so good.</p></div>", "Body text is here, truly."),
        ("<article><p>a < b and c</p><script>if (a < b) x('</p>')</script><style>p{}</style><!-- <p>no</p> --><p>end<", "a < b and c\nend<"),
        ("<p>one</p><p>two", "one\ntwo"), ("just text", "just text"), ("", ""), (None, ""), ("<div><div><nav><a>x</a></nav></div></div>", ""),
        ("<article><form><p>Your name, please, now</p></form><div class=notice>We use cookies, yes</div><p>Text, that counts.</p><aside>ad</aside></article>", "Text, that counts."),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


LONG = "This sentence is long enough, and has commas, so that it counts as prose. "


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article><div class=body><p>{LONG}<p>{LONG}</div><ul><li>One<li>Two</ul><h4>Head</h4><p>Last</article>", [LONG, LONG, "One", "Two", "Head", "Last"]),
        (f"<article><section><p>{LONG}<p>{LONG}</section><section><p>Short</section></article>", [LONG, LONG, "Short"]),
        (f"<article><p>A lead without a stop<div><p>{LONG}<p>{LONG}</div></article>", ["A lead without a stop", LONG, LONG]),
        (f"<article><div><p>{LONG}<p>{LONG}</div><div><p>End</div></article>", [LONG, LONG, "End"]),
        (f"<body><div class='layout has-sidebar'><article><p>{LONG}</article><div class=sidebar><p>{LONG}</div></div>", [LONG]),
        (f"<body><form><article><p>{LONG}<p>End</article></form><footer>f</footer>", [LONG, "End"]), (f"<body><form><div class=x><p>{LONG}<p>{LONG}</div></form><div class=footer>foot text</div>", [LONG, LONG]),
        (f"<article><p>{LONG}<p class='related-work'>Related<section id='social-history'><p>History</section></article>", [LONG, "Related", "History"]),
        (f"<article><p>{LONG}</article><div class='comment-list'><p>{LONG * 9}<p>{LONG * 9}</div>", [LONG]),
        (f"<div class='post no-comments'><p>{LONG}<p>End</div><div class='site-footer'>x</div><div id='cookie-notice'>y</div>", [LONG, "End"]),
    ],
)
def test_whole_articles_are_kept(page, text):
    assert html.main_text(page) == "\n".join(x.strip() for x in text)


def test_deep_and_broken_pages():
    assert html.main_text("<div>" * 20_000 + "<p>deep text, here</p>") == "deep text, here"
    random.seed(3)
    bits = ["<p>", "</p>", "<div class='", "'>", "<a href=\"", "&am", "text, ", "<", ">", "<!--", "-->", "<script>", "</b>", "<td>", "<li>", "\x00"]
    for _ in range(300):
        assert isinstance(html.main_text("".join(random.choices(bits, k=30))), str)


def test_pages_of_the_table(spark):
    def plain(h):
        a = re.search(r"(?s)<article>(.*?)(</article>|$)", h)[1]
        import html as entities

        parts = (" ".join(entities.unescape(re.sub(r"<[^>]*(>|$)", "", x.replace("<br>", " "))).split()) for x in re.split(r"<(?:/?(?:p|h1|article))>", a))
        return "\n".join(x for x in parts if x)

    pages = {r["page_id"]: r["html"] for r in table(spark, SF, "pages").collect()}
    assert all(r["text"] == plain(pages[r["page_id"]]) and r["n_chars"] == len(r["text"]) for r in queries.op2_html(spark, SF).collect())


# 3 near duplicates


def brute_components(prints: dict, bits: int) -> dict:
    ids, par = sorted(prints), {}

    def find(x):
        while par.setdefault(x, x) != x:
            x = par[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                par[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints_are_those_of_the_definition(spark, documents):
    x = spark.sql("select xxhash64('a b c d') h, xxhash64('b c d é') g").first()
    hashes = [h & (2**64 - 1) for h in (x["h"], x["g"])]
    want = sum(1 << j for j in range(64) if sum(h >> j & 1 for h in hashes) * 2 > 2)
    assert simhash.fingerprint("A  b\tC d é") == want and simhash.fingerprint(None) == 0


@pytest.mark.parametrize("block", [4096, 64, 3, 2])
def test_groups_match_brute_force(spark, block):
    random.seed(5)
    base = [random.getrandbits(64) for _ in range(6)]
    fps = list(base)
    for b in base[:4]:  # dense groups and chains
        at = b
        for _ in range(25):
            at ^= sum(1 << k for k in random.sample(range(64), random.randint(1, 5)))
            fps += [at, b ^ sum(1 << k for k in random.sample(range(64), random.randint(1, 6)))]
    fps = dict(enumerate(dict.fromkeys(fps)))
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps.values()], "fp long")
    roots = {r["node"]: r["root"] for r in components.connected_components(simhash.links(df, 4, block)).collect()}
    got = collections.defaultdict(set)
    for i, f in fps.items():
        got[roots.get(simhash.signed(f), simhash.signed(f))].add(i)
    want = collections.defaultdict(set)
    for i, r in brute_components(fps, 4).items():
        want[r].add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def brute_likeness(docs: dict, least: float) -> dict:
    sets, par = {}, {i: i for i in docs}
    for i, t in docs.items():
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] == sets[b] or len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= least:
                x, y = find(a), find(b)
                par[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("cut, block", [(None, 4096), ((2, 8), 4096), ((2, 8), 16)])
def test_near_copies_match_brute_force(spark, documents, odd, nothing, cut, block):
    """The cuts given find each pair of the least likeness but for one in a thousand, whatever the block."""
    assert simhash.representatives(nothing).count() == 0
    assert simhash.near_copies(odd).count() == len(ODD) and simhash.representatives(odd).count() == 5
    random.seed(9)
    base = [str(random.random()) for _ in range(150)]
    crowd = {}
    for i in range(60):  # a chain of edits from one text and many that meet at its places with a likeness about the least
        w = list(base) if i % 2 else crowd[i - 2].split() if i else list(base)
        for k in random.sample(range(150), 2 + i % 3):
            w[k] = str(random.random())
        crowd[i] = " ".join(w)
    for docs in (crowd, {r["doc_id"]: r["text"] for r in documents.collect()}):
        df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
        kept, want = {r["doc_id"] for r in simhash.representatives(df, cut=cut, block=block, shingles_in_block=simhash.SHINGLES if block > 16 else 1000).collect()}, set(brute_likeness(docs, 0.8).values())
        if cut:
            assert kept == want
        else:  # no link is wrong, and nine of ten are found
            assert kept >= want and len(docs) - len(kept) >= 0.9 * (len(docs) - len(want))


def test_pipeline_drops_near_copies_that_fingerprints_miss(spark, documents):
    import corpus_pipeline

    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, documents, SF).collect()}
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in documents.collect()}
    assert (prints[1] ^ prints[177]).bit_count() > 4 and 1 in kept and 177 not in kept


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 130)) and got[201] == 200
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# 4 toxicity


def test_restoring_and_scoring():
    lm = toxicity.CharacterModel({w: 9.0 for w in "idiot stupid clown scum trash loser moron worthless the and of house".split()})
    r = toxicity.Restorer(lm)
    assert r.restore("you 1d10t, $tup1d cl0wn! s c u m l.o.s.e.r m0r0n! WORTHLE55 trrrrash")[0] == "you idiot, stupid clown! scum loser moron! worthless trash"
    assert r.restore("plain text, 12 of 30%. The and***")[0] == "plain text, 12 of 30%. the and***" and r.restore("")[0] == ""
    assert toxicity.probability({"scum": 7.0}, -5.0, "such scum") > 0.5 > toxicity.probability({"scum": 7.0}, -5.0, "such sun")


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op4_toxicity(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in got) / len(got) >= 0.9 and all(0 <= r["score"] <= 1 for r in got)
    labels = table(spark, sf, "labels")
    flipped = labels.withColumn("toxic", F.when(fold_crc("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    docs = table(spark, sf, "documents").where(fold_crc("doc_id", 5) != 0)
    assert toxicity.train(docs, labels.where(fold_crc("doc_id", 5) != 0)) == toxicity.train(docs, flipped.where(fold_crc("doc_id", 5) != 0))


# 5 language model


@pytest.mark.parametrize("pass_bytes, heavy", [(lmscore.PASS_BYTES, lmscore.HEAVY), (1 << 15, 300)])
def test_scores_match_exact_counts(spark, documents, pass_bytes, heavy):
    docs = documents.select("doc_id", "text")
    docs = docs.unionByName(docs.limit(5))  # repeated rows
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in rows}
    words = {i: (t or "").encode().lower().split() + [lmscore.END] for i, t in rows.items()}
    c, pair, before = collections.Counter(), collections.Counter(), collections.Counter()
    train = docs.where(fold_crc("doc_id", 7) != 2)
    for r in train.collect():
        w = words[r["doc_id"]]
        c.update(w), pair.update(zip([lmscore.START, *w], w)), before.update([lmscore.START, *w[:-1]])
    n, v = sum(c.values()), len(c)
    got = lmscore.score(docs, train, pass_bytes=pass_bytes, heavy=heavy).collect()
    assert len(got) == len(rows) + 5
    gain = 0
    for r in got:
        w = words[r["doc_id"]]
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        exact = 0.0
        for h, x in zip([lmscore.START, *w], w):
            mu = lmscore.MU * max(before[h], 1) ** lmscore.POWER
            exact += math.log10((pair[h, x] + mu * (c[x] + 1) / (n + v + 1)) / (before[h] + mu))
        assert r["score"] <= 0 and r["score"] == pytest.approx(exact, abs=0.25 * len(w))
        gain += (r["score"] - base) * held[r["doc_id"]]
    assert gain > 0


def test_filter_never_reads_less_than_was_put_in():
    h = lmscore.mix(np.arange(1, 5001, dtype=np.uint64))
    q = 1 + np.arange(5000) % 9
    f = lmscore.Filter(1, {0: len(lmscore.build_shard(h, q))})
    f.put(0, lmscore.build_shard(h, q).tobytes())
    got = f.levels(h)
    assert (got >= q).all() and (got == q).mean() > 0.9 and (f.levels(lmscore.mix(np.arange(10_000, 30_000, dtype=np.uint64))) > 0).mean() < 0.08


# 6 decontamination


def brute_hits(text, items, span=10):
    words = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) if w]
    w, hit, found = words(text), set(), []
    for i, t in items:
        x = words(t)
        n = min(span, len(x))
        windows = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)} if n else set()
        at = [k for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows] if windows else []
        hit.update(p for k in at for p in range(k, k + n))
        found += [str(i)] * bool(at)
    return len(w), len(hit), sorted(found)


def test_windows_match_brute_force(spark):
    random.seed(7)
    vocabulary = ["a", "B", "ç", "d1", "e"]
    item = lambda n: " ".join(random.choices(vocabulary, k=n))
    items = [(i, item(n)) for i, n in enumerate([0, 1, 2, 3, 9, 9, 10, 11, 14, 25, 25])] + [(50, None)]
    items.append((51, items[-3][1]))
    docs = [(i, ", ".join([item(random.randint(0, 30)), *(random.choice(items)[1] or "" for _ in range(random.randint(0, 2))), item(5)])) for i in range(60)] + [(60, None), (61, "")]
    got = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    for r in got:
        assert (r["n_words"], r["n_hit"], r["items"]) == brute_hits(dict(docs)[r["doc_id"]], items), r["doc_id"]
        assert r["contaminated"] == (r["n_hit"] > 0)


def test_native_operators_run_no_python(spark):
    for name in ("op6_decontaminate", "op7_licenses"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan), name


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    from oracle import rows_of_df, rows_of_sql

    assert rows_of_df(queries.QUERIES[name](spark, SF)) == rows_of_sql(queries.ORACLES[name])


# 7 licences


def test_licence_spellings_are_one(spark):
    t = "(c) 2020 Someone\n" + licenses.MIT.replace("sublicense", "sub-licence").upper()
    docs = spark.createDataFrame([(1, t), (2, licenses.MIT + " More."), (3, "Text.\nreleased under the MIT licence\nAll Rights Reserved"), (4, None), (5, "© 2020")], "doc_id long, text string")
    got = {r["doc_id"]: (r["license_id"], r["notices"]) for r in licenses.scan(docs).collect()}
    assert got == {1: ("MIT", []), 2: (None, []), 3: (None, ["LicenseRef-all-rights-reserved", "MIT"]), 4: (None, []), 5: (None, [])}


# 8 fingerprints


def test_edited_texts_and_likeness(spark, documents):
    for docs in (documents, documents.unionByName(documents.limit(3))):
        rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (-r[0], r[1]))
        want = collections.Counter()
        for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
            e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
            a, b, c = (set(re.findall("." * 8, spotsigs.as_text(spotsigs.signature(x)))) for x in (t, e, n))
            like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
            want[i, len(t), hashlib.sha256(e.encode()).hexdigest(), round(like(a, b), 9), round(like(a, c), 9)] += 1
        got = spotsigs.edit_likeness(docs, ranges=7).collect()
        assert want == collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got)


def test_likeness_join_matches_brute_force(spark):
    random.seed(11)
    words = [f"wort{i}" for i in range(30)]
    texts = []
    for _ in range(25):
        t = [w for _ in range(30) for w in ("der", random.choice(words), random.choice(words))]
        texts.append(" ".join(t))
        for _ in range(3):
            u = list(t)
            for k in random.sample(range(len(u)), random.randint(1, 6)):
                u[k] = random.choice(words)
            texts.append(" ".join(u))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs, members = spotsigs.near_duplicates(spotsigs.fingerprints(docs), 0.6)
    got = {(r["fingerprint_a"], r["fingerprint_b"]) for r in pairs.collect()}
    sigs = {spotsigs.as_text(s): s for s in map(spotsigs.signature, texts)}
    want = {(a, b) for a in sigs for b in sigs if a < b and spotsigs.jaccard(sigs[a], sigs[b]) >= 0.6}
    assert got == want and want and members.count() == len(texts)


# 9 BPE


def test_encoding_is_that_of_the_library(spark, documents):
    from tokenizers import Tokenizer

    file = queries.tokenizer_file()
    t, c = Tokenizer.from_file(file), bpe.Codec(open(file, "rb").read())
    random.seed(1)
    some = list(c.v.id_of)
    texts = [b"".join(random.choices(some, k=random.randint(1, 5))).decode("utf8", "ignore") for _ in range(4000)]
    texts += ["", " ", "a<|endoftext|>b", "<|endoftext|>", "aaaa" * 50, "  x\n\n y 　z", "don't I'LL", "١٢٣ ⅷ²x", "é​🙂👨‍👩‍👧"] + [chr(i) * 2 + " " + chr(i) for i in range(1, 0x3100, 7)]
    texts += [r["text"] or "" for r in documents.collect()]
    got = [np.frombuffer(x, np.int32).tolist() for x in c.encode(texts)]
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert got == want
    assert [c.decode(x) for x in got] == [t.decode(x, skip_special_tokens=False) for x in want]
    assert 0 < c.failed < c.speculated
    assert {r["doc_id"]: r["text"] for r in bpe.bpe_decode(bpe.bpe_encode(documents, file), file).collect()} == {r["doc_id"]: r["text"] or "" for r in documents.collect()}


# 10 personal data


def test_pseudonyms_keep_form_and_turn_back():
    p = pii.Pseudonymizer(b"secret")
    text = "Mail a.b1@x.com, +1 (017) 555-7713, 4111 1111 1111 1111, 9807915762804490, 97.51.17.173, 2021-02-28, 3/7/2021, 123-45-6789, GB82 WEST 1234 5698 7654 32."
    spans = p.spans(text)
    assert [s[2] for s in spans] == ["email", "phone", "card", "account", "ipv4", "date", "date", "ssn", "iban"]
    out = pii.apply_spans(text, spans)
    assert not any(text[a:b] in out for a, b, _, _ in spans) and pii.apply_spans(text, p.spans(text)) == out
    back = pii.Pseudonymizer(b"secret")
    form = {"card": "number", "account": "number"}
    for a, b, kind, new in spans:
        assert re.sub(r"[0-9A-Za-z]", "x", new) == re.sub(r"[0-9A-Za-z]", "x", text[a:b]) or kind in ("ipv4", "date")
        if kind != "date":
            assert back.replace(form.get(kind, kind), new, back=True)[1] == text[a:b]
        if kind == "card":
            digits = re.sub(r"\D", "", new)
            assert pii.luhn_digit(digits[:-1]) == digits[-1]
    assert pii.Pseudonymizer(b"other").spans(text) != spans


def test_what_is_not_valid_stays():
    p = pii.Pseudonymizer(b"k")
    for t in ("2021-02-30", "999.1.1.1", "666-12-1234", "Version 4.0.", '"9233A8ECF7C5B09FE5949719B6B82BC439E9329B"', "v1.2.3", "12345"):
        assert p.spans(t) == [], t


def test_feistel_is_a_permutation():
    f = pii.Permutation(b"k")
    for n in (1, 2, 7, 100, 1000):
        got = [f(x, n, "t") for x in range(n)]
        assert sorted(got) == list(range(n)) and [f(y, n, "t", back=True) for y in got] == list(range(n))


# pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    kinds = docs.schema
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs
        if name != "bpe":
            assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in kinds]
    n = {k: d.count() for k, d in kept.items()}
    assert table(spark, SF, "documents").count() >= n["toxicity"] >= n["near_duplicates"] >= n["decontamination"] == n["pii"] == n["bpe"] > 0
    # this stage has no contract: five words and a likeness of 0.8, not op3's four words and four bits
    texts = {r["doc_id"]: r["text"] for r in kept["toxicity"].collect()}
    assert {r["doc_id"] for r in kept["near_duplicates"].collect()} == set(brute_likeness(texts, 0.8).values())
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    assert {r["doc_id"] for r in kept["decontamination"].collect()} == {r["doc_id"] for r in kept["near_duplicates"].collect() if not brute_hits(r["text"], items)[1]}
    run = corpus_pipeline.run(spark, SF)
    assert sorted(r["ids_sha256"] for r in run.collect()) == sorted(r["ids_sha256"] for r in kept["bpe"].collect())
    assert isinstance(run.schema["ids"].dataType, T.ArrayType)


def test_pipeline_stages_take_odd_and_empty_tables(spark, tmp_path):
    import corpus_pipeline

    for name, rows in (("odd", ODD), ("none", [])):
        docs = spark.createDataFrame(rows, DOCS)
        folder = str(tmp_path / name)
        spark.createDataFrame([(1, 0, 0), (4, 0, 0), (None, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, "the cat is on the mat and the dog is in the house"), (2, "wort"), (3, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        n = {"toxicity": len(rows), "near_duplicates": 5 if rows else 0, "decontamination": 4 if rows else 0, "pii": 4 if rows else 0, "bpe": 4 if rows else 0}
        for k, (stage, f) in enumerate(corpus_pipeline.STAGES):
            out = f(spark, docs, folder)
            out.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            assert docs.count() == n[stage], stage  # the item of one word drops nothing, the window of twelve does
        assert set(docs.columns) >= {"doc_id", "lang", "id", "score", "carry", "h", "ids"}


# long texts, repeated rows, ties


def test_long_words_and_runs_take_little_time():
    import time

    from tokenizers import Tokenizer

    file = queries.tokenizer_file()
    codec, lm = bpe.Codec(open(file, "rb").read()), toxicity.CharacterModel({"idiot": 9.0})
    random.seed(2)
    word = "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=20_000))
    for w in (word, "a" * 5001, "ab" * 2000 + "c", "é" * 3000):
        assert np.frombuffer(codec.encode([w])[0], np.int32).tolist() == Tokenizer.from_file(file).encode(w, add_special_tokens=False).ids
    runs = ["%" * 1_000_000 + "a", "1" * 1_000_000 + "-a", "a" * 1_000_000, "ab" * 500_000, "_" * 1_000_000, "a1" * 100_000, " a" * 100_000]
    restorer, p = toxicity.Restorer(lm), pii.Pseudonymizer(b"k")
    for x in (*runs, word * 50):
        start = time.time()
        restorer.restore(x), codec.encode([x]), simhash.fingerprint(x), spotsigs.signature(x), html.main_text("<p>" + x), p.spans(x), langid.letters_only(x)
        assert time.time() - start < 60, x[:9]


def test_language_needs_a_letter(spark):
    docs = spark.createDataFrame([(1, "² ½"), (2, "Ⅷ ①"), (3, "x")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang"] for r in langid.identify(docs, {"de": b"der die das " * 50, "en": b"the of and " * 50}).collect()}
    assert got[1] == got[2] == "und" and got[3] != "und"


def test_language_is_that_of_the_smallest_total(spark, documents):
    """Brute force: each text compressed as defined, one by one."""
    import zstandard

    dictionaries = langid.train_dictionaries(documents.where(fold_crc("doc_id", 5) != 0))
    made = {}
    for k, v in dictionaries.items():
        cut = min(langid.PRIME_BYTES, len(v) // 4)
        made[k] = v[:cut], zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(v[cut:], dict_type=zstandard.DICT_TYPE_RAWCONTENT), level=5, write_content_size=False, write_dict_id=False)
    texts = {r["doc_id"]: langid.letters_only(r["text"]) for r in documents.collect()}
    for r in langid.identify(documents, dictionaries).collect():
        t = texts[r["doc_id"]]
        if not t:
            assert r["lang"] == "und" and r["score"] == 0
            continue
        blocks = [b" " + t[i : i + langid.BLOCK_CHARS].encode() for i in range(0, len(t), langid.BLOCK_CHARS)]
        sizes = {k: sum(len(c.compress(p + b)) - len(c.compress(p)) for b in blocks) for k, (p, c) in made.items()}
        assert r["lang"] == min(sorted(sizes), key=sizes.get)


def test_toxicity_query_matches_plain_scoring(spark, documents):
    """Brute force: each text restored and its telling words summed, one by one."""
    docs = documents.select("doc_id", "text")
    model = toxicity.train(docs.where(fold_crc("doc_id", 5) != 0), table(spark, SF, "labels").where(fold_crc("doc_id", 5) != 0))
    lm = toxicity.CharacterModel(model["words"])
    for r in queries.op4_toxicity(spark, SF).join(docs, "doc_id").collect():
        words = set(re.findall(r"[^\W_]+", toxicity.Restorer(lm).restore(r["text"] or "")[0]))
        z = model["bias"] + sum(w for k, w in model["weights"].items() if k in words)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)) if z > -700 else 0.0) and r["predicted"] == (r["score"] >= 0.5)


def test_repeated_rows_teach_once(spark):
    rows = [(i, f"common words and {'scum' if i % 4 == 0 else 'friend'} w{i % 7}") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    once, twice = (spark.createDataFrame(r, "doc_id long, text string") for r in (rows, rows + rows[:50] * 3))
    assert toxicity.train(once, labels) == toxicity.train(twice, labels)


@pytest.mark.parametrize("width", range(50, 121, 7))
def test_licences_are_known_however_they_are_wrapped(spark, width):
    import textwrap

    rows = [(i, name, "\n\n".join(textwrap.fill(p, width) for p in ("Copyright (c) 2021 Someone\n\n" + text).split("\n\n"))) for i, (name, text) in enumerate(licenses.KNOWN)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, name string, text string")).collect()
    assert {r["doc_id"]: r["license_id"] for r in got} == {i: name for i, name, _ in rows}


def test_ids_of_any_type_have_a_next_text(spark):
    docs = spark.createDataFrame([("b", "eins zwei"), ("a", "drei vier"), (None, "fünf sechs"), ("c", "")], "doc_id string, text string")
    got = {r["doc_id"]: r["edited_sha256"] for r in spotsigs.edit_likeness(docs, ranges=3).collect()}
    order = [("c", ""), ("b", "eins zwei"), ("a", "drei vier"), (None, "fünf sechs")]
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        assert got[i] == hashlib.sha256(spotsigs.edited(t, n).encode()).hexdigest()


def test_texts_without_anchors_have_spots_all_over():
    assert len(spotsigs.signature(" ".join(f"слово{i}" for i in range(500)))) > 15


def test_pseudonym_query_matches_plain_replacement(spark, documents):
    p = pii.Pseudonymizer(pii.session_key(spark))
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in queries.op10_pii(spark, SF).collect():
        t = texts[r["doc_id"]]
        spans = p.spans(t) if t else []
        assert r["text"] == (pii.apply_spans(t, spans) if t else t) and r["n_replaced"] == len(spans) and r["kinds"] == ",".join(s[2] for s in spans)


def test_dates_before_a_time_are_found():
    p = pii.Pseudonymizer(b"k")
    (a, b, kind, new), = p.spans("at 2021-02-28T10:00:00Z")
    assert kind == "date" and new == p.spans("on 2021-02-28.")[0][3]


def test_keys_are_secret_and_last(spark):
    assert pii.session_key(spark) == pii.session_key(spark) != b"a key for tests"
    with pytest.raises(ValueError):
        pii.pseudonymize(spark.createDataFrame([], DOCS), b"")
