import base64
import hashlib
import itertools
import pickle
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from conftest import rows
from pyspark.sql import functions as F

from signalloom.llm import (
    components,
    decontaminate,
    fingerprints,
    html_text,
    mixing,
    near_copies,
    pii,
    quality,
    simhash,
    suffix_dedup,
    toxicity,
    warc,
)
from signalloom.operators import staging
from signalloom.operators.staging import staging_path

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, fp STRING, score STRING, size STRING"
WORDS = "the of and to in is that it was for on are as with his they at be this from".split()


def text_of(rng, n, words=WORDS):
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))


def corpus():
    """Ids, texts and sources with nulls, empty and long texts, copies, repeated rows and a null id."""
    rng = random.Random(5)
    texts = [text_of(rng, rng.randrange(3, 200)) for _ in range(30)]
    out = [(i, t, f"s{i % 3}") for i, t in enumerate(texts)]
    passage = text_of(rng, 60)
    out += [(100 + i, f"{text_of(rng, 20)} {passage} {text_of(rng, 20)}", "s1") for i in range(5)]
    out += [(200, texts[0], "s2"), (201, texts[0], None), (3, texts[3], "s0"), (3, texts[3], "s0"), (300, None, "s0")]
    out += [(301, "", "s0"), (302, "   \n", None), (None, texts[1], "s1"), (303, "é" * 40 + "日本語" * 30, "s2")]
    out += [(304, text_of(rng, 9000), "s2"), (305, "For " * 300, "s2"), (306, texts[2] + " more", "s0")]
    return out


def frame(spark, data):
    full = [(i, t, "en", s, len(t or ""), "x", "x", "x") for i, t, s in data]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus()).repartition(3).cache()


def test_components_follow_long_paths(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (7, 7), (60, 61)]
    found = components.components(spark.createDataFrame(edges, "a LONG, b LONG"))
    expected = {i: 0 for i in range(41)} | {100: 50, 50: 50, 60: 60, 61: 60}
    assert dict(map(tuple, found.collect())) == expected
    assert components.components(spark.createDataFrame([], "a LONG, b LONG")).isEmpty()


# WARC


def pages(spark):
    big = "<p>" + "x" * 2000 + "</p>"
    data = [(1, "http://a/1", big), (2, "http://a/2", big), (5, None, big), (3, "u", "small"), (4, "u\nv", "small"), (6, "u", None)]
    data += [(None, "n", big), (7, "é", "é" * 3000), (7, "é", "é" * 3000), (8, "r", "".join(random.Random(1).choices("ab<>é", k=400_000)))]
    return spark.createDataFrame(data, "page_id LONG, url STRING, html STRING"), data


def test_warc_round_trip(spark):
    df, data = pages(spark)
    expected = []
    for i, _, h in data:
        raw = (h or "").encode()
        same = [j for j, _, g in data if g == h and j is not None]
        revisit = len(raw) >= 1000 and same and i != max(same)
        expected.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, warc.round_trip(df).collect()), key=key) == sorted(expected, key=key)
    assert warc.round_trip(df.where("false")).isEmpty()


def test_warc_splits_anywhere_give_every_record_once(spark):
    archives = warc.written(pages(spark)[0].coalesce(1), staging_path(spark, "warc-test"))
    whole = sorted(r.offset for r in warc.read(archives, 1 << 40).collect())
    assert len(whole) == 10
    for split in (61, 997, 70_000):
        assert sorted(r.offset for r in warc.read(archives, split).collect()) == whole


def test_warc_keeps_pages_of_very_long_urls(spark):
    rng = random.Random(3)
    urls = ["data:," + "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=200_000)) for _ in range(2)]
    data = [(1, urls[0], "x" * 3000), (2, urls[1], "x" * 3000), (3, "u", "y")]
    df = spark.createDataFrame(data, "page_id LONG, url STRING, html STRING").coalesce(1)
    found = rows(warc.round_trip(df), "page_id", "record_type", "refers_to")
    assert found == [(1, "revisit", 2), (2, "response", None), (3, "response", None)]
    archives = warc.written(df, staging_path(spark, "warc-long"))
    assert {r.url for r in warc.read(archives, 70_000).collect()} == {"u", *urls}


def test_a_false_magic_is_no_record():
    class File:
        def __init__(self, data):
            self.data = data

        def read_at(self, n, at):
            return self.data[at : at + n]

    good = warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    data = warc.MAGIC + b"noise" + good + zlib.compress(b"x") + warc.MAGIC
    found = list(warc.records_between(File(data), 0, len(data)))
    assert [at for at, _, _ in found] == [8]
    assert found[0][1]["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b"payload").digest()).decode()


# Suffix-array dedup


def repeats(data):
    seen = defaultdict(lambda: suffix_dedup.NO_ID + 1)
    number = lambda i: suffix_dedup.NO_ID if i is None else i
    raw = [(number(i), i, (t or "").encode()) for i, t, _ in data]
    for n, _, b in raw:
        for s in range(len(b) - 49):
            seen[b[s : s + 50]] = min(seen[b[s : s + 50]], n)
    out = []
    for n, i, b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - 49):
            if seen[b[s : s + 50]] < n:
                gone[s : s + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [suffix_dedup.CHUNK, 50])
def test_suffix_dedup_is_exact(docs, monkeypatch, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    found = sorted(map(tuple, suffix_dedup.without_repeats(docs).collect()), key=str)
    assert found == repeats(corpus())
    assert suffix_dedup.without_repeats(docs.where("false")).isEmpty()


def test_kept_positions_don_t_depend_on_what_is_around():
    rng = random.Random(3)
    shared = bytes(rng.choices(b"abcd ", k=400))
    names = []
    for _ in range(2):
        data = np.frombuffer(bytes(rng.choices(b"abcd ", k=90)) + shared + bytes(rng.choices(b"abcd ", k=90)), np.uint8)
        first, last, gram, reach = suffix_dedup.kept_positions(suffix_dedup.Names(data))
        assert first[0] == 0 and last[-1] == len(data) - 50 and (first[1:] == last[:-1] + 1).all()
        names.append(set(reach[(first >= 140) & (last <= 390)].tolist()))
    assert names[0] == names[1] and names[0]


# Mixing


def targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    whole, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in capped]
        level = (whole - sum(capped.values())) / sum(weight[s] for s in free) if free else 0
        more = {s: 3.0 * sizes[s] for s in free if 3 * sizes[s] < weight[s] * level}
        if not more:
            return capped | {s: weight[s] * level for s in free}
        capped |= more


@pytest.mark.parametrize("piece", [mixing.PIECE, 4])
def test_the_mix_meets_its_targets(spark, docs, monkeypatch, piece):
    monkeypatch.setattr(mixing, "PIECE", piece)
    found = mixing.mixed(docs).toPandas()
    again = mixing.mixed(docs.repartition(5)).toPandas()
    columns = ["doc_id", "size", "taken"]
    assert sorted(map(str, found[columns].values.tolist())) == sorted(map(str, again[columns].values.tolist()))
    size_of = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(found["size"]) == sorted(size_of(t) for _, t, _ in corpus())
    assert (found["taken"] <= 3 * found["size"]).all() and (found["taken"] >= 0).all()
    sizes = Counter()
    for _, t, s in corpus():
        sizes[s] += size_of(t)
    wanted = targets(dict(sizes))
    for source, target in wanted.items():
        own = found[found["source"].isna()] if source is None else found[found["source"] == source]
        assert own["target"].iloc[0] == pytest.approx(target)
        assert own["taken"].sum() == pytest.approx(target, rel=0.01, abs=12)
    assert mixing.mixed(docs.where("false")).isEmpty()
    nothing = mixing.mixed(frame(spark, [(1, None, "a"), (2, "", None)]))
    assert rows(nothing, "doc_id", "taken", "target") == [(1, 0, 0.0), (2, 0, 0.0)]


# Classifiers


def labelled(spark, bad):
    rng = random.Random(9)
    data = [(i, text_of(rng, 60) + (bad(rng) if i % 4 == 0 else "")) for i in range(400)]
    docs = frame(spark, [(i, t, "s") for i, t in data] + [(None, "x", "s"), (900, None, "s"), (901, "", "s"), (5, data[5][1], "s")])
    return docs, [(i, int(i % 4 == 0)) for i, _ in data]


def judged(found, labels):
    by_id = defaultdict(list)
    for r in found.collect():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        by_id[r.doc_id].append(r)
    held = {i: y for i, y in labels if by_id[i][0].held_out}
    assert held and sum(by_id[i][0].predicted == y for i, y in held.items()) >= 0.95 * len(held)
    return by_id


def test_toxicity_learns_words_and_beginnings_of_words(spark):
    docs, labels = labelled(spark, lambda rng: f" you snarg{rng.choice(['le', 'ling', 'lord'])} fool")
    table = spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id LONG, toxic INT").withColumn("text", F.lit("clash"))
    by_id = judged(toxicity.toxicity(docs, table), labels)
    assert len(by_id[5]) == 2 and {r.predicted for r in by_id[900] + by_id[901]} == {0}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, rs in by_id.items() if i is not None for r in rs)
    kept = toxicity.accepted(docs, table)
    assert kept.columns == docs.columns and 290 <= kept.count() <= 320
    none = toxicity.toxicity(docs, table.where("false"))
    assert none.count() == docs.count() and toxicity.toxicity(docs.where("false"), table).isEmpty()


def test_toxicity_weighs_every_word_also_of_few_examples(spark):
    rng = random.Random(4)
    data = [(i, text_of(rng, 30) + (f" snargle{rng.randrange(3)} fool" if i % 6 == 0 else "")) for i in range(60)]
    data += [(100, text_of(rng, 40) + " snargle1"), (101, text_of(rng, 40)), (102, "unheard of")]
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(60)], "doc_id LONG, toxic INT")
    docs = frame(spark, [(i, t, "s") for i, t in data])
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(r.evidence and 0 < len(r.terms) <= toxicity.SHOWN for r in found.values() if r.doc_id != 102)
    assert found[100].score > found[101].score
    index = toxicity.learned(docs, labels)
    _, w = index.vectors([dict(data)[100]])[0]
    assert len(w) == len({t for x in toxicity.words(dict(data)[100]) for t in toxicity.terms_of(x)}) and w.min() > 0
    assert w @ w == pytest.approx(1)
    sent = pickle.loads(pickle.dumps(index))
    vectors = {i: dict(zip(*map(np.ndarray.tolist, v))) for i, v in zip(dict(data), index.vectors([t for _, t in data]))}
    for i, v in vectors.items():
        near = sent.search(v, 5)
        every = {int(e): sum(x * vectors[int(e)].get(t, 0) for t, x in v.items()) for e in sent.ids}
        best = sorted((c for c in every.values() if c > 0), reverse=True)[:5]
        assert [c for c, _ in near] == pytest.approx(best) == [every[int(sent.ids[e])] for _, e in near]


def test_block_max_search_equals_a_full_comparison():
    rng = np.random.default_rng(2)
    index = toxicity.BlockMaxIndex({f"t{i}": i for i in range(30)}, np.ones(30), 4)

    def vector():
        at = rng.choice(30, rng.integers(1, 6), replace=False)
        w = rng.random(len(at))
        return dict(zip(sorted(at.tolist()), (w / np.sqrt(w @ w)).tolist()))

    examples = [(i, i % 2, vector()) for i in range(200)]
    index.build(examples)
    for _ in range(50):
        v = vector()
        every = [(round(sum(x * e[2].get(t, 0) for t, x in v.items()), 9), -e[0]) for e in examples]
        best = [(c, -i) for c, i in sorted((x for x in every if x[0] > 0), reverse=True)[:9]]
        assert [(c, int(index.ids[i])) for c, i in index.search(v, 9)] == best


def test_quality_tells_junk_from_prose(spark):
    docs, labels = labelled(spark, lambda rng: " %%% $$$" * 60)
    labels = [(i, 1 - y) for i, y in labels]
    table = spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id LONG, quality INT")
    by_id = judged(quality.quality(docs, table), labels)
    assert len(by_id[5]) == 2 and by_id[900][0].score == by_id[901][0].score
    assert {r.score for r in quality.quality(docs, table.where("false")).collect()} == {0.5}
    assert quality.quality(docs.where("false"), table).isEmpty()


# HTML


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body>
<nav><ul><li><a href=/a>Menu</a></ul></nav><div class="ad">Buy!</div>%s<footer>&copy; us</footer></body></html>"""


def test_html_keeps_the_article_alone():
    article = "<article><header><h1>Head &amp;  line</h1></header><p>One<br>two&nbsp;&#233;<p><b>three</b> <div class=share>Like</div>"
    page = PAGE % (article + "<table><tr><td>a<td>b</tr></table><!-- <p>no --><section id=comments><p>I say</p></section></article>")
    assert html_text.main_lines(html_text.lines_of(page)) == ["Head & line", "One two é", "three", "a b"]
    assert html_text.lines_of("") == [] and html_text.main_lines(html_text.lines_of("<p>a<p>b < c")) == ["a", "b < c"]
    assert html_text.main_lines(html_text.lines_of("<script>never closed <p>x")) == []
    assert html_text.main_lines(html_text.lines_of("<p role=alert>No<p>Yes<p hidden>No<p>Too")) == ["Yes", "Too"]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(60):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(9))] for _ in range(2))
        best = max(n for n in range(len(a) + 1) for c in itertools.combinations(a, n) if _inside(c, b))
        found = html_text.shared_lines(np.array(a, np.int64), np.array(b, np.int64))
        assert len(found) == best and found == sorted(found) and _inside([a[i] for i in found], b)


def test_pages_of_the_same_lines_over_and_over_are_aligned_in_time():
    rng = random.Random(8)
    for _ in range(40):
        a, b = (np.array([rng.randrange(3) for _ in range(rng.randrange(300, 420))], np.int64) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        found = html_text.shared_lines(a, b)
        assert found == sorted(set(found)) and len(found) == table[-1, -1] and _inside(a[found].tolist(), b.tolist())
        assert html_text._lengths(a, b).tolist() == table[-1].tolist()
    start = time.monotonic()
    assert len(html_text.shared_lines(np.zeros(40_000, np.int64), np.zeros(40_001, np.int64))) == 40_000
    many = np.array([rng.randrange(5) for _ in range(20_000)], np.int64)
    assert len(html_text.shared_lines(many, many[::-1].copy())) > 10_000
    assert time.monotonic() - start < 30


def test_class_names_count_as_a_whole():
    def left(page):
        return html_text.main_lines(html_text.lines_of(page))

    assert left('<div class="content has-sidebar"><article><p>body</p></article></div>') == ["body"]
    assert left('<article><section id="search-engines"><p>on engines</p></section></article>') == ["on engines"]
    for name in ("siteFooter", "site-footer", "comments-section", "ad-slot-3", "newsletterSignup", "share_buttons", "cookie-banner", "AD"):
        assert left(f'<div class="x {name}"><p>no</p></div><p>yes</p>') == ["yes"], name
    for name in ("no-sidebar", "with-comments", "adventure", "share-prices", "search-engines", "cookie-recipes"):
        assert left(f'<div class="x {name}"><p>yes</p></div>') == ["yes"], name


def test_a_teaser_article_does_not_hide_the_body(spark):
    page = '<div>Site</div><article><p>Teaser %d</p></article><div><p>Body %d</p></div>'
    df = spark.createDataFrame([(i, f"http://t/{i}", page % (i, i)) for i in range(4)], "page_id LONG, url STRING, html STRING")
    assert {r.page_id: r.text for r in html_text.extracted(df).collect()} == {i: f"Teaser {i}\nBody {i}" for i in range(4)}


def test_extraction_is_that_of_comparing_all_pages_of_a_host(spark):
    rng = random.Random(12)
    data = []
    for i in range(300):
        host = "hot" if rng.random() < 0.5 else f"h{rng.randrange(12)}"
        section = rng.randrange(4)
        shown = [f"all {k}" for k in range(3) if rng.random() < 0.8] + [f"section {section} {k}" for k in range(3) if rng.random() < 0.8]
        body = [f"own {rng.randrange(200)}"] if rng.random() < 0.9 else []
        quoted = "<article><p>quoted</p></article>" if rng.random() < 0.3 else ""
        html = "<nav>menu</nav>" + "".join(f"<p>{x}</p>" for x in shown + body) + quoted + "<p>end</p>"
        data.append((i, f"https://{host}/{section}/{rng.randrange(1000)}?x", html))
    df = spark.createDataFrame(data + [data[7]], "page_id LONG, url STRING, html STRING").repartition(5)

    pages = {}
    for i, url, html in data:
        host, path = url.split("?")[0].removeprefix("https://").split("/", 1)
        lines = html_text.lines_of(html)
        key = (tuple(x.text for x in lines), html_text.said_of(lines))
        pages.setdefault(host, {}).setdefault(key, []).append(("/" + path, i))
    digests = {(bytes(r.hashes), bytes(r.said)): bytes(r.digest) for r in html_text.parsed(df).collect()}

    def digest(lines, said):
        return digests[b"".join(xxhash.xxh64_digest(x.encode()) for x in lines), said]

    want = {}
    for found in pages.values():
        ranked = sorted((min(p for p, _ in v), digest(*k), k) for k, v in found.items())
        for at, (path, _, key) in enumerate(ranked):
            near = [ranked[j] for j in (at - 1, at + 1) if 0 <= j < len(ranked)]
            near.sort(key=lambda x: -html_text.closeness(x[0], path))
            text = [x for x, said in zip(*key) if said != html_text.ASIDE_LINE]
            for _, _, other in near:
                rest = [x for x, said in zip(*key) if said == html_text.MAIN_LINE or (said == 0 and x not in other[0])]
                if rest:
                    text = rest
                    break
            want.update((i, "\n".join(text)) for _, i in found[key])
    rows = html_text.extracted(df).collect()
    assert len(rows) == 301 and {r.page_id: r.text for r in rows} == want


def _inside(c, b):
    it = iter(b)
    return all(x in it for x in c)


def test_pages_lose_what_the_page_of_the_nearest_url_has_too(spark):
    page = "<div>Site of all things</div><p>%s</p><p>%s</p><div>Read our terms</div>"
    data = [(i, f"http://h/{d}/{i}", page % (f"only {i}", f"here {i}")) for d in "ab" for i in range(3 * (d == "b"), 3 + 3 * (d == "b"))]
    data += [(20, "http://copy/1", page % ("x", "y")), (21, "http://copy/2", page % ("x", "y")), (30, None, "<p>alone</p>"), (31, "http://e/", None)]
    data += [(40, "http://h/c/1", PAGE % "<article><p>Site of all things</p></article>"), (None, "bad url", ""), (0, data[0][1], data[0][2])]
    df = spark.createDataFrame([(*r, "clash") for r in data], "page_id LONG, url STRING, html STRING, text STRING").repartition(4)
    found = defaultdict(set)
    for r in html_text.extracted(df).collect():
        assert r.n_chars == len(r.text)
        found[r.page_id].add(r.text)
    assert {i: found[i] for i in range(1, 6)} == {i: {f"only {i}\nhere {i}"} for i in range(1, 6)}
    assert found[20] == found[21] == {"Site of all things\nx\ny\nRead our terms"}
    assert found[30] == {"alone"} and found[31] == found[None] == {""} and found[40] == {"Site of all things"}
    assert html_text.extracted(df.where("false")).isEmpty()


# PII


def test_surrogates_keep_format_and_tell_entities_apart(spark):
    texts = [
        "Call (212) 555-0100 or 212-555-0100, +44 20 7946 0958.",
        "Mail A.B@Example.ORG and a.b@example.org; card 4111 1111 1111 1111 / 4111-1111-1111-1111, not 4111111111111112.",
        'Mr. John Smith met Mrs. Ann Lee, Mr John Smith, Госпожа Иванова. token = "abcdef0123456789abcd" 10.1.2.3 8.8.8.8',
        "Version 2.0. of 3. items at 12:30, 1,000,000 and 2024-01-02", None, "", "no digits = none",
    ]
    data = [(i, t, "s") for i, t in enumerate(texts)] + [(1, texts[1], "s"), (None, texts[0], "s")]
    df = frame(spark, data)
    out = pii.pseudonymised(df, "key")
    assert out.columns == [*df.columns, "n_replaced"] and out.count() == len(data)
    by_id = {r.doc_id: r for r in out.collect()}
    assert [by_id[i].text for i in (3, 4, 5, 6)] == texts[3:] and by_id[None].text == by_id[0].text
    assert [by_id[i].n_replaced for i in range(7)] == [3, 4, 7, 0, 0, 0, 0]
    a, b = re.search(r"\((\d{3})\) (\d{3}-\d{4}) or (\d{3}-\d{3}-\d{4}), \+44 ", by_id[0].text), by_id[1].text
    assert f"{a[1]}-{a[2]}" == a[3] != "212-555-0100"
    mails = re.findall(r"\S+@\S+\.(?:ORG|org)", b)
    assert mails[0].lower() == mails[1] != "a.b@example.org" and mails[0] != mails[1]
    cards = [re.sub(r"\D", "", c) for c in re.findall(r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}", b)]
    assert cards[0] == cards[1] != "4" + "1" * 15 and "4111111111111112" in b
    luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(cards[0])))
    assert luhn % 10 == 0
    c = by_id[2].text
    assert not re.search("Smith|Lee|Иванова|abcdef|8\\.8\\.8\\.8", c) and re.search(r"10\.\d+\.\d+\.\d+ \d+\.", c)
    john = re.findall(r"M[rR]\.? (\S+) (\S+?)[ ,]", c)
    assert re.search(r"Mrs\. \w+a \w+a,", c) and re.search(r"Госпожа [А-Я][а-я]+ова\.", c) and john
    assert re.search(r'token = "[0-9a-f]{20}"', c)
    assert pii.pseudonymised(df.where("false"), "key").isEmpty()
    assert pii.pseudonymised(df, "other").where("doc_id = 0").first().text != by_id[0].text


def test_names_are_replaced_word_by_word(spark):
    texts = [
        "Prof. Dr. Anna Müller spoke.", "Mrs. Anna Maria Schmidt spoke.", "Mr. J. Smith spoke.", "Frau Dr. Schmidt spoke.",
        "Mr. John Smith met Mr. Smith, Dr. Smith and Herr Prof. Dr. Klaus-Peter Müller-Lüdenscheidt.", "Mr. É. Ünal and Mr. K spoke.",
        "MR. X, Drew Barry and Mr Ed", "Господин И. Иванов",
    ]
    out = {r.doc_id: r for r in pii.pseudonymised(frame(spark, [(i, t, "s") for i, t in enumerate(texts)]), "key").collect()}
    for i in range(6):
        assert not re.search("Anna|Maria|Müller|Schmidt|Smith|John|Klaus|Peter|Lüden|J\\.|É|Ünal|K ", out[i].text), out[i].text
    assert re.fullmatch(r"Prof\. Dr\. [A-Z][a-z]+ [A-Z][a-z]+ spoke\.", out[0].text)
    assert re.fullmatch(r"Mrs\. [A-Z][a-z]+a [A-Z][a-z]+a [A-Z][a-z]+a spoke\.", out[1].text)
    smith = re.fullmatch(r"Mr\. [A-Z]\. ([A-Z][a-z]+o) spoke\.", out[2].text)[1]
    assert out[3].text == f"Frau Dr. {out[1].text.split()[3]} spoke."
    assert re.fullmatch(rf"Mr\. [A-Z][a-z]+o {smith} met Mr\. {smith}, Dr\. {smith[:-1]} and Herr Prof\. Dr\. \w+-\w+ \w+-\w+\.", out[4].text)
    assert re.fullmatch(r"Mr\. [À-Ž]\. [A-Z][a-z]+o and Mr\. [A-Z] spoke\.", out[5].text)
    assert out[6].text.startswith("MR. X, Drew Barry and Mr ") and not out[6].text.endswith("Ed")
    assert re.fullmatch(r"Господин [А-Я]\. [А-Я][а-я]+ов", out[7].text) and "И." not in out[7].text
    assert [out[i].n_replaced for i in range(8)] == [1, 1, 1, 1, 4, 2, 1, 1]


def test_columns_that_operators_name_themselves_may_be_there(spark):
    names = ["text_hash", "replaced_by", "TEXT_HASH_OF_ROW", "text_hash_of_row_", "fingerprint_of_row", "form", "pos", "node", "key", "seq"]
    data = [(i, f"one two three four five six {i // 2} Mr. Smith", "s") for i in range(6)] + [(2, None, "s")]
    df = frame(spark, data).withColumns({c: F.concat(F.lit(f"{c} "), F.coalesce("doc_id", F.lit(0))) for c in names})
    for out, n in ((pii.pseudonymised(df, "key").drop("n_replaced"), 7), (near_copies.deduplicated(df), 4), (simhash.deduplicated(df), None)):
        found = out.collect()
        assert out.columns == df.columns and all(r[c] == f"{c} {r.doc_id}" for r in found for c in names)
        assert n in (None, len(found)) and found


def test_colliding_surrogates_are_drawn_again(spark):
    forms = spark.range(3000).select(F.format_string("10.0.%d.%d", F.expr("id div 200"), F.expr("id % 200 + 1")).alias("form"))
    found = pii.surrogates(pii.typed(forms), "key").toPandas()
    assert len(found) == 3000 == found.surrogate.nunique() and not set(found.surrogate) & set(found.norm)
    forms = spark.createDataFrame([(f"password = {'a' * 15}{x}",) for x in "aeiou"], "form STRING")
    assert pii.surrogates(pii.typed(forms), "key").toPandas().surrogate.nunique() == 5


def test_few_possible_surrogates_don_t_clash_for_ever(spark):
    texts = [f"+1{i}" for i in range(2300, 2500)] + ["+1 23 45", "+2 23 45", "password = ----------------"]
    texts += [f"{a}@{b}.co" for a in "aeiou" for b in "aeiou"]
    found = pii.surrogates(pii.typed(spark.createDataFrame([(t,) for t in texts], "form STRING")), "key").toPandas()
    assert len(found) == found.groupby(["type", "surrogate"]).ngroups == 201 + 1 + 25
    assert not set(found.surrogate) & set(found.norm)
    assert len({s[1:] for s in found[found.type == "phone"].surrogate}) > 100
    df = frame(spark, [(i, f"call {t} now", "s") for i, t in enumerate(texts)])
    out = {r.doc_id: r for r in pii.pseudonymised(df, "key").collect()}
    assert all(out[i].n_replaced == 1 and f"call {t} now" != out[i].text for i, t in enumerate(texts))


# Decontamination


def test_benchmark_passages_are_found_and_nothing_else(spark):
    rng = random.Random(8)
    items = [(i, text_of(rng, n)) for i, n in enumerate([40, 40, 25, 12, 3])]
    near = items[0][1].split()
    near[20:21] = []
    table = spark.createDataFrame([(i, t, "c") for i, t in [*items, (9, None), (None, "x y"), (7, "..."), (8, items[1][1])]], "item_id LONG, text STRING, doc_id STRING")
    data = [
        (1, f"{text_of(rng, 50)} {items[0][1].upper()}! {text_of(rng, 50)}", "s"), (2, text_of(rng, 300), "s"), (3, None, "s"), (4, "", "s"),
        (5, items[1][1].replace(" ", ", "), "s"), (6, f"{items[2][1]} {items[3][1]}", "s"), (6, f"{items[2][1]} {items[3][1]}", "s"),
        (7, " ".join(items[0][1].split()[:15]), "s"), (8, f"a {items[4][1]} b", "s"), (None, items[3][1], "s"),
    ]
    docs = frame(spark, data)
    found = rows(decontaminate.contaminated(docs, table), "doc_id", "item_id", "similarity")
    assert found == [(1, 0, 1.0), (5, 1, 1.0), (6, 2, 1.0), (6, 2, 1.0), (6, 3, 1.0), (6, 3, 1.0), (8, 4, 1.0), (None, 3, 1.0)]
    clean = decontaminate.decontaminated(docs, table)
    assert clean.columns == docs.columns and rows(clean, "doc_id") == [(2,), (3,), (4,), (7,)]
    split = decontaminate.item_indices(table, most=600)
    assert len(split) > 1 and sum(len(x.ids) for x in split) == 5
    assert decontaminate.contaminated(docs.where("false"), table).isEmpty()
    assert decontaminate.contaminated(docs, table.where("false")).isEmpty()


def test_windows_equal_brute_force():
    rng = random.Random(6)
    hashes = decontaminate.WordHashes()
    hashed = lambda t: np.array([hashes[w] for w in t.split()], np.uint64)
    missed = total = 0
    for _ in range(40):
        item = text_of(rng, 60)
        words = item.split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "changed"
        doc = hashed(f"{text_of(rng, 80)} {' '.join(words)} {text_of(rng, 80)}")
        own, whole = decontaminate.shingle_hashes(doc, 5), decontaminate.shingle_hashes(hashed(item), 5)
        counts = Counter(whole.tolist())
        best = max(decontaminate.weighted_similarity(own[s : s + 56], counts, 56) for s in range(len(own) - 55))
        index = decontaminate.ItemIndex().build([(1, item)])
        found = index.matches(doc, 0.8)
        total += best >= 0.8
        if found:
            assert best >= 0.8 and found[0][0] == pytest.approx(best)
        missed += best >= 0.8 and not found
    assert total and not missed


# SimHash


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reachable(fps):
    """Fingerprint -> those reachable over at most four differing bits."""
    out, rest = {}, set(fps)
    while rest:
        group, todo = set(), [rest.pop()]
        while todo:
            x = todo.pop()
            group.add(x)
            near = {y for y in rest if (x ^ y).bit_count() <= 4}
            rest -= near
            todo += near
        out |= {x: group for x in group}
    return out


def test_simhash_digest_equals_brute_force(spark, docs):
    fps = [(i, slow_fingerprint(t)) for i, t, _ in corpus()]
    groups = reachable([f for _, f in fps])
    expected = [(i, f"{f:016x}", min((j for j, g in fps if g in groups[f] and j is not None), default=None)) for i, f in fps]
    assert sorted(map(tuple, simhash.digest(docs).collect()), key=str) == sorted(expected, key=str)
    assert simhash.digest(docs.where("false")).isEmpty()
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(rows(kept, "doc_id")) == sorted({(c,) for _, _, c in expected})


def test_fingerprints_within_the_radius_share_a_key():
    golay, rng = simhash.Golay(), np.random.default_rng(7)
    assert sorted(set(golay.counts.tolist())) == [1, 6]
    for _ in range(300):
        x = rng.integers(0, 1 << 63, dtype=np.int64)
        flips = rng.choice(64, rng.integers(0, 5), replace=False)
        y = (np.uint64(x) ^ np.bitwise_xor.reduce(np.append(np.uint64(1) << flips.astype(np.uint64), np.uint64(0)))).view(np.int64)
        keys, at = simhash.fuzzy_keys(np.array([x, y], np.int64), golay)
        assert set(keys[at == 0].tolist()) & set(keys[at == 1].tolist())


@pytest.mark.parametrize("piece", [simhash.PIECE, 16])
def test_links_connect_large_groups_in_pieces_too(spark, piece):
    rng = random.Random(1)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for centre in list(fps)[:3]:
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6))) for _ in range(120)}
    fps |= {x ^ (1 << 63) for x in list(fps)[:40]}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp LONG").repartition(2), piece)
    found = dict(map(tuple, components.components(links).collect()))
    for x, group in reachable(fps).items():
        least = min(y - (1 << 64) if y >> 63 else y for y in group)
        assert found.get(x - (1 << 64) if x >> 63 else x, least) == least


# Fingerprints


def test_samples_estimate_generalised_jaccard():
    rng, sampler = random.Random(3), fingerprints.Sampler(1024, kept=300)
    for _ in range(5):
        a = [rng.choice("abcdefghij") + str(rng.randrange(9)) for _ in range(200)]
        b = a[: rng.randrange(200)] + [rng.choice("klmno") for _ in range(60)]
        x, y = Counter(a), Counter(b)
        truth = sum((x & y).values()) / sum((x | y).values())
        assert fingerprints.likeness(sampler(" ".join(a)), sampler(" ".join(b))) == pytest.approx(truth, abs=0.07)
    rng.shuffle(a)
    assert (sampler(" ".join(a)) == sampler(" ".join(sorted(a)))).all()
    many = " ".join(f"w{i}" for i in range(1000))
    assert (sampler(many) == fingerprints.Sampler(1024)(many)).all()


def test_every_document_is_compared_with_the_next(spark, docs):
    key = lambda r: (r[0] is None, -(r[0] or 0))
    data = sorted(corpus(), key=key)
    sampler = fingerprints.Sampler()
    expected = Counter()
    for (i, t, _), (_, u, _) in zip(data, data[1:] + data[:1]):
        t, u = t or "", u or ""
        cut = len(t) // 3
        edited = t[: len(t) - cut] + u[:cut]
        near = fingerprints.likeness(sampler(t), sampler(edited))
        expected[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.shown(sampler(t)), fingerprints.shown(sampler(edited)), near, fingerprints.likeness(sampler(t), sampler(u))] += 1
    assert Counter(map(tuple, fingerprints.compared(docs).collect())) == expected
    one = fingerprints.compared(docs.where("doc_id = 304")).first()
    assert one.near_next == 1.0
    assert fingerprints.compared(docs.where("false")).isEmpty()
    own = {r.doc_id: r.fingerprint for r in fingerprints.fingerprinted(docs).collect()}
    assert own[200] == own[201] == own[0] and own[300] == own[301] == "0" * 256


def test_no_document_of_64_bit_ids_is_lost(spark):
    rng = random.Random(6)
    ids = sorted({rng.getrandbits(63) | 1 for _ in range(60)} | {-(1 << 63), (1 << 63) - 1}, reverse=True)
    texts = {i: text_of(rng, 12) for i in ids}
    found = fingerprints.compared(frame(spark, [(i, texts[i], "s") for i in ids]).repartition(4))
    edited = {}
    for i, j in zip(ids, ids[1:] + ids[:1]):
        cut = len(texts[i]) // 3
        edited[i] = hashlib.sha256((texts[i][: len(texts[i]) - cut] + texts[j][:cut]).encode()).hexdigest()
    assert rows(found, "doc_id", "edited_sha256") == rows(spark.createDataFrame(list(edited.items()), "a LONG, b STRING"))


# Near copies


def five_word_sets(texts):
    out = {}
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[t] = frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()
    return out


def near_copy_groups(texts):
    """Text -> all texts that links of similarity 0.8 or more reach; texts without words reach each other."""
    sets, rest, out = five_word_sets(texts), set(texts), {}
    while rest:
        group, todo = set(), [rest.pop()]
        while todo:
            x = todo.pop()
            group.add(x)
            a = sets[x]
            near = {y for y in rest if a == sets[y] or len(a & sets[y]) >= 0.8 * len(a | sets[y]) > 0}
            rest -= near
            todo += near
        out |= {x: group for x in group}
    return out


def edited(rng, text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("piece_bytes", [near_copies.PIECE_BYTES, 3000])
def test_near_copies_equal_brute_force(spark, piece_bytes):
    rng = random.Random(8)
    data = corpus()
    for start in range(400, 460, 10):
        base = text_of(rng, rng.randrange(60, 250))
        n = len(base.split())
        # Copies of an inner text are copies of each other through it alone; heavier edits are no copies.
        data += [(start + 9 - k, edited(rng, base, k * n // 70), "s1") for k in range(6)]
    hub = text_of(rng, 120)
    data += [(500 + k, edited(rng, hub, 2), "s0") for k in range(25)] + [(600, hub, "s0")]
    passage = text_of(rng, 70)
    data += [(700 + k, f"{passage} {text_of(rng, 30)}", "s2") for k in range(20)]
    groups = near_copy_groups({t for _, t, _ in data})
    least = {}
    for i, t, _ in data:
        key = frozenset(groups[t])
        least[key] = min((x for x in (least.get(key), i) if x is not None), default=None)
    docs = frame(spark, data).repartition(3)
    kept = near_copies.deduplicated(docs, piece_bytes)
    assert kept.columns == docs.columns
    assert sorted(kept.toPandas()["doc_id"].tolist()) == sorted(least.values())
    assert len(groups[hub]) == 26 and len(groups[data[-1][1]]) == 1
    assert near_copies.deduplicated(docs.where("false")).isEmpty()


# The pipeline


def test_every_stage_acts_and_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    docs, labels = labelled(spark, lambda rng: " you snargle fool")
    passage = text_of(rng, 50)
    extra = [(1000, f"{text_of(rng, 30)} {passage}", "t"), (1001, docs.where("doc_id = 1").first().text, "t"), (1002, f"{text_of(rng, 60)} mail x.y@example.com", "t")]
    base = docs.where("doc_id is not null").unionByName(frame(spark, extra)).select("doc_id", "text", "lang", "source", "n_chars")
    folder = str(tmp_path)
    base.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id LONG, toxic INT").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id LONG, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    kept = spark.read.parquet(f"{folder}/documents.parquet")
    ids = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, folder)
        assert kept.columns == base.columns
        kept.write.parquet(f"{folder}/{name}")
        kept = spark.read.parquet(f"{folder}/{name}")
        ids.append({r.doc_id for r in kept.select("doc_id").collect()})
    toxic = {i for i, y in labels if y}
    every = {r.doc_id for r in base.collect()}
    assert ids[0] == every - toxic
    assert ids[1] == ids[0] - {1001, 901} and kept.where("doc_id = 5").count() == 1
    assert ids[2] == ids[3] == ids[1] - {1000}
    changed = kept.where("doc_id = 1002").first()
    assert "x.y@example.com" not in changed.text and changed.n_chars == len(changed.text)
    mix = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in mix.collect()} == ids[3]


def test_shingles_are_those_of_the_words_whatever_the_blocks(monkeypatch):
    texts = [b"", b" \n", b"one", b"One two\tTHREE", b"a b c d e f a b c d e", "äÖ 中文 \x00 x".encode(), b"word " * 40 + b"x" * 300]
    whole = [near_copies.shingle_hashes(t) for t in texts]
    hashes = {}
    for text, got in zip(texts, whole):
        words = text.lower().split()
        want = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
        assert len(got) == len(want)
        for shingle, value in zip(want, got.tolist()):
            assert hashes.setdefault(shingle, value) == value
    assert len(set(hashes.values())) == len(hashes)
    near_copies._places.cache_clear()
    monkeypatch.setattr(near_copies, "BLOCK_BYTES", 7)
    assert all((near_copies.shingle_hashes(t) == w).all() for t, w in zip(texts, whole))
    near_copies._places.cache_clear()


def test_an_index_is_unpacked_in_little_more_memory_than_it_takes():
    import tracemalloc

    rng = np.random.default_rng(3)
    n, n_terms, length = 4000, 30_000, 200
    hashes = np.arange(n_terms, dtype=np.int64)
    t = np.concatenate([np.sort(rng.choice(n_terms, length, replace=False)) for _ in range(n)]).astype(np.int32)
    index = toxicity.BlockMaxIndex(toxicity.Vocabulary(hashes), rng.random(n_terms) + 1, 64)
    tf = rng.integers(1, 5, len(t)).astype(np.int32)
    index.build_counts(np.arange(n), rng.integers(0, 2, n), np.full(n, length), t, tf)
    sent = pickle.dumps(index)
    tracemalloc.start()
    try:
        found = pickle.loads(sent)
        kept, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert most < 1.9 * kept
    # Its lists are short, and are read whole: the result is that of a full comparison.
    q = np.unique(rng.choice(n_terms, 300)).astype(np.int64)
    w = rng.random(len(q))
    w /= np.sqrt(w @ w)
    dense = np.zeros(n_terms)
    dense[q] = w
    cosines = np.zeros(n)
    np.add.at(cosines, np.repeat(np.arange(n), length), dense[t] * (1 + np.log(tf)) * index.weights[t])
    place = {int(e): i for i, e in enumerate(found.ids)}
    by_place = np.array([cosines[e] for e in sorted(place, key=place.get)]) / found.norms
    got = found.search((q, w), 10)
    assert np.allclose([c for c, _ in got], np.sort(by_place)[::-1][:10], atol=2e-9)
    assert np.allclose([by_place[i] for _, i in got], [c for c, _ in got], atol=2e-9)


def test_names_of_terms_are_forgotten_with_their_words_and_documents_are_counted_once():
    texts = [" ".join(f"word{i}abc" for i in range(at, at + 20)) + " same same" for at in range(0, 2000, 20)]
    known = {t for text in texts for w in toxicity.words(text) for t in toxicity.terms_of(w)}
    terms = toxicity.Vocabulary(np.array([toxicity.hash_of(t) for t in known], np.int64))
    lookup, counts = toxicity.Lookup(terms, 100), np.zeros(len(terms), np.int64)
    for at in range(0, len(texts), 4):
        lookup.add_documents(texts[at : at + 4], counts)
        assert len(lookup.names) <= 2 * 100
    want = {toxicity.hash_of(t): sum(t in {x for w in toxicity.words(text) for x in toxicity.terms_of(w)} for text in texts) for t in known}
    assert dict(zip(terms.hashes.tolist(), counts.tolist())) == want


def test_shingles_are_gone_before_the_texts_of_kept_documents_are_read(spark, tmp_path):
    rng = random.Random(8)
    texts = [text_of(rng, 60) for _ in range(30)]
    docs = frame(spark, [(i, t + (" end" if i >= 30 else ""), "s") for i, t in enumerate(texts + texts)])
    token = staging._area.set(str(tmp_path / "area"))
    try:
        found = near_copies.deduplicated(docs)
        left = {x.name.split("-")[0] for x in (tmp_path / "area").iterdir()}
    finally:
        staging._area.reset(token)
    assert left == {"kept"}
    assert sorted(r.doc_id for r in found.collect()) == list(range(30))


def test_sets_that_cannot_be_broadcast_give_the_same_links(spark, monkeypatch):
    rng = random.Random(9)
    texts = [text_of(rng, 60) for _ in range(30)]
    docs = frame(spark, [(i, t + (" end" if i >= 20 else ""), "s") for i, t in enumerate(texts + texts[:15])])
    rows = staging.staged(near_copies.described(docs), "rows")
    links = [sorted(map(tuple, near_copies.verified_links(rows).collect()))]
    monkeypatch.setattr(near_copies, "broadcast_if_small", lambda df: df)
    links.append(sorted(map(tuple, near_copies.verified_links(rows).collect())))
    assert links[0] == links[1] and len(links[0]) == 15


def test_documents_are_scored_from_stored_counts_as_from_their_texts(spark):
    """Words are found once: counts make the same frequencies and, to the ninth digit, the same scores as texts."""
    rng = random.Random(11)
    data = [(i, text_of(rng, 30) + (f" snargle{rng.randrange(3)} fool fool" if i % 6 == 0 else ""), "s") for i in range(80)]
    docs = frame(spark, [*data, (900, None, "s"), (901, "unheard zzzzzzzz", "s"), (902, "", "s")])
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(60)], "doc_id LONG, toxic INT")
    index = toxicity.learned(docs, labels)
    counts = staging.staged(toxicity.counted(docs, index.terms), "counts")
    for a, b in zip(toxicity.counted_frequencies(counts, index.terms), toxicity.document_frequencies(docs, index.terms)):
        assert np.array_equal(a, b)
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    sent, params = pickle.loads(pickle.dumps(index)), toxicity.ToxicityParams()
    for i, text in texts.items():
        v = index.vectors([text])[0]
        score, near = toxicity.vote(sent, v, params)
        assert got[i].score == pytest.approx(score, abs=1e-8)
        assert [e.doc_id for e in got[i].evidence] == [int(sent.ids[e]) for _, e in near[:5]]
        assert set(got[i].terms) <= {t for w in toxicity.words(text) for t in toxicity.terms_of(w)}


def test_common_terms_in_single_precision_leave_cosines_exact():
    rng = np.random.default_rng(12)
    n, n_terms = 600, 400
    lengths = rng.integers(1, 60, n)
    t = np.concatenate([np.sort(rng.choice(n_terms, k, replace=False, p=(p := 1 / np.arange(1, n_terms + 1)) / p.sum())) for k in lengths]).astype(np.int32)
    tf = rng.integers(1, 9, len(t)).astype(np.int32)
    index = toxicity.BlockMaxIndex(toxicity.Vocabulary(np.arange(n_terms, dtype=np.int64)), rng.random(n_terms) + 1, 16)
    index.build_counts(np.arange(n), rng.integers(0, 2, n), lengths, t, tf)
    found = pickle.loads(pickle.dumps(index))
    assert found.rows.dtype == np.float32 and len(found.rows) > 10
    dense = np.zeros((n, n_terms))
    dense[np.repeat(np.arange(n), lengths), t] = (1 + np.log(tf)) * index.weights[t]
    dense /= np.sqrt((dense**2).sum(axis=1, keepdims=True))
    for e in range(0, n, 20):
        q = np.flatnonzero(dense[e])
        near = found.search((q, dense[e][q]), 10)
        want = np.sort(np.round(dense @ dense[e], 9))[::-1][:10]
        assert [c for c, _ in near] == pytest.approx([x for x in want if x > 0], abs=1.1e-9)
        assert all(c == pytest.approx(dense[found.ids[i]] @ dense[e], abs=1.1e-9) for c, i in near)


def test_lists_without_blocks_and_tables_of_parts_take_little_memory_and_leave_results_exact(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(toxicity, "PART", 100)
    rng = np.random.default_rng(15)
    n, own_terms, rare, languages = 1200, 300, 20_000, 3
    n_terms = languages * own_terms + rare
    examples = []
    for e in range(n):
        # Words of its language, frequent and less so, some of the next one, and many that few examples have.
        share = 1 / np.arange(1, own_terms + 1)
        mine = rng.choice(own_terms, 60, replace=False, p=share / share.sum()) + e % languages * own_terms
        other = rng.choice(own_terms, 3, replace=False) + (e + 1) % languages * own_terms
        examples.append(np.sort(np.concatenate([mine, other, rng.choice(rare, 200, replace=False) + languages * own_terms])))
    lengths, t = np.array([len(x) for x in examples]), np.concatenate(examples).astype(np.int32)
    tf = np.where(rng.random(len(t)) < 0.1, rng.integers(2, 900, len(t)), 1).astype(np.int32)
    index = toxicity.BlockMaxIndex(toxicity.Vocabulary(np.arange(n_terms, dtype=np.int64)), rng.random(n_terms) + 1, 64)
    index.build_counts(np.arange(n), rng.integers(0, 2, n), lengths, t, tf)
    sent = pickle.dumps(index)
    tracemalloc.start()
    try:
        found = pickle.loads(sent)
        kept, _ = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    # Apart from what each term and each cell takes: two bytes a posting and ten for those that weigh more, not blocks of one posting.
    fixed = found.lookup.word.nbytes * 2 + found.rows.nbytes + 100 * n_terms
    assert len(found.tables) > 1 and kept < fixed + 5 * len(t)
    dense = np.zeros((n, n_terms))
    dense[np.repeat(np.arange(n), lengths), t] = (1 + np.log(tf)) * index.weights[t]
    dense /= np.sqrt((dense**2).sum(axis=1, keepdims=True))
    queries = [(np.flatnonzero(dense[e]), dense[e][dense[e] > 0]) for e in range(0, n, 24)]
    queries += [(np.zeros(0, np.int64), np.zeros(0)), (np.array([n_terms + 5]), np.ones(1))]
    for (q, w), near in zip(queries, found.nearest(queries, 10, ties=True)):
        v = np.zeros(n_terms)
        v[q[q < n_terms]] = w[q < n_terms]
        want = np.sort(np.round(dense @ v, 9))[::-1][:10]
        assert [c for c, _ in near][:10] == pytest.approx([x for x in want if x > 0], abs=1.1e-9)
        assert all(c == pytest.approx(dense[found.ids[i]] @ v, abs=1.1e-9) for c, i in near)
        assert near[:10] == found.search((q, w), 10)
    # Lists that are kept in blocks, and are looked into block by block, give the same.
    monkeypatch.setattr(toxicity.BlockMaxIndex, "WORTH", 1)
    blocks = pickle.loads(sent)
    assert len(blocks.blocks) > len(found.blocks)
    assert list(blocks.nearest(queries, 10)) == list(found.nearest(queries, 10))
