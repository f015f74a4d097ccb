import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from signalloom.llm import conversations, ranked_search, sharding

CLASHING = "lang STRING, source STRING, row STRING, shard STRING, `order` STRING, size STRING, n STRING, ids STRING, terms STRING, hub STRING, kind STRING, copies STRING, digest STRING, place STRING"


def with_clashes(df):
    return df.withColumns({c.split()[0].strip("`"): F.lit("x") for c in CLASHING.split(", ")})


def key(row):
    return tuple((x is None, str(x)) for x in row)


# Ranked search


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def ranked_by_hand(docs, items, best):
    held = [(i, Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            m = 10 + 90 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(words(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:best])]
    return out


@pytest.fixture(scope="module")
def searched():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["Édé", "ÉDÉ", "naïve", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(700)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)] + [(5, docs[5][1])] * 3 + [(None, docs[5][1]), (None, docs[7][1])]
    docs += [(2000, None), (2001, ""), (2002, " .,!"), (2003, "W1-W2_w1" + " w3" * 5000), (2004, "ÉDÉ é")]
    items = [(i, text(12)) for i in range(12)] + [(3, docs[5][1])] * 2 + [(20, None), (21, "?!"), (22, "unheard"), (None, "W0 w1")]
    return docs, items


@pytest.mark.parametrize("bounds", [(8192, 64, 1 << 20), (40, 2, 50), (8192, 1000, 300)])
def test_ranked_search_is_that_of_a_full_scan(spark, searched, monkeypatch, bounds):
    for name, value in zip(("VOCABULARY", "BLOCK", "POSTINGS"), bounds):
        monkeypatch.setattr(ranked_search, name, value)
    docs, items = searched
    df = with_clashes(spark.createDataFrame(docs, "doc_id LONG, text STRING").repartition(3))
    asked = with_clashes(spark.createDataFrame(items, "item_id LONG, text STRING"))
    for best in (10, 1):
        found = ranked_search.ranked(df, asked, best)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, found.collect()), key=key) == sorted(ranked_by_hand(docs, items, best), key=key)


def test_blocks_are_skipped_and_bounds_hold(searched):
    import numpy as np

    rng = np.random.default_rng(1)
    size, count = 30, 2000
    lengths = rng.integers(1, 6, count)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    ids = np.concatenate([rng.choice(size, n, replace=False) for n in lengths])
    impacts = rng.integers(1, 1 << 34, len(ids))
    searches = ranked_search.Searches([np.array([1, 4, 7])], size, 3)
    shard = ranked_search.Shard(starts, ids, impacts, searches)
    blocks, asked = shard.lists[1], np.isin(np.arange(size), [1, 4, 7])
    assert sorted(blocks.docs) == sorted({i for i in range(count) if 1 in ids[starts[i] : starts[i + 1]]})
    scores = shard.scores(np.arange(count), asked)
    bound = blocks.summary[:, searches.places[0][1]].sum(axis=1, dtype=float)
    assert all(scores[blocks.docs[a:b]].max() <= x for a, b, x in zip(blocks.starts, blocks.ends, bound))
    least = np.sort(scores)[-3]
    assert len(blocks.passing(searches.places[0][1], least)) < len(blocks.docs)


def test_ranked_search_of_nothing(spark, searched):
    docs = spark.createDataFrame(searched[0][:20], "doc_id LONG, text STRING")
    items = spark.createDataFrame(searched[1], "item_id LONG, text STRING")
    assert ranked_search.ranked(docs.where("false"), items).isEmpty()
    assert ranked_search.ranked(docs, items.where("false")).isEmpty()


# Conversations


def repaired_by_hand(rows):
    """The cheapest repair, row by row over plain strings."""
    talks = defaultdict(list)
    for c, t, r, x in rows:
        named = f"{' ' if c is None else c}:{' ' if t is None else t}"
        roll, r, x = zlib.crc32(named.encode()) % 20, " " if r is None else r, " " if x is None else x
        x = "" if roll == 1 else re.sub("[.!?]", "", x) if roll == 2 else x
        talks[c] += [(t, "user" if roll == 4 else r, x)] * {0: 0, 3: 2}.get(roll, 1)
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    named = {"u": "user", "a": "assistant"}
    out = []
    for c, said in talks.items():
        said.sort(key=lambda y: (y[0] is not None, y[0] or 0, y[1], hashlib.md5(y[2].encode()).hexdigest()))
        turns = [t for t, _, _ in said if t is not None]
        faults, seen = [], set()
        for _, r, x in said:
            ends = re.findall(r"[^\x20\x09-\x0D]", x)[-1:]
            faults.append("blank" if not ends else "copy" if (r, x) in seen else "cut" if ends[0] not in ".!?" else "")
            seen.add((r, x))

        def better(states, state, cost, audit, lines):
            if state not in states or (cost, audit) < states[state][:2]:
                states[state] = (cost, audit, lines)

        def with_insertions(states):
            for _ in range(4):
                for s, (cost, audit, lines) in list(states.items()):
                    for i in set(after[s]) & set("ua"):
                        better(states, i, cost + 3, audit + "I", [*lines, f"{named[i]}:"])
            return states

        states = with_insertions({"": (0, "", [])})
        for (_, r, x), fault in zip(said, faults):
            following = {}
            for s, (cost, audit, lines) in states.items():
                better(following, s, cost + 4, audit + "D", lines)
                if fault in ("blank", "copy"):
                    continue
                extra = 3 * (fault == "cut")
                if r and r[0] in after[s]:
                    better(following, r[0], cost + extra, audit + "K", [*lines, f"{r}:{x}"])
                for i in set(after[s]) & set("ua"):
                    better(following, i, cost + 3 + extra, audit + "R", [*lines, f"{named[i]}:{x}"])
            states = with_insertions(following)
        cost, audit, lines = min((states[s] for s in ("", "a") if s in states), key=lambda y: y[:2])
        odd = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, gaps, *map(faults.count, ("blank", "copy", "cut")), odd, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def talk():
    rng = random.Random(9)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "umpire"]
    texts = ["Yes.", "No!", "why", " \t\n", "", None, "Well? \n", "é.", "x" * 50_000 + "!"]
    some = lambda x, w: rng.choices(x, w)[0]
    row = lambda c, t: (c, t, some(roles, [9, 9, 3, 1, 1, 1, 1, 1]), some(texts, [6, 6, 2, 1, 1, 1, 4, 4, 1]) if rng.random() < 0.5 else f"{rng.random()}.")
    rows = [row(c, some([t, None, t + 2, t - 1], [9, 1, 1, 1])) for c in range(120) for t in range(rng.randrange(1, 9))]
    rows += [row(500, t) for t in range(900)] + [row(None, t) for t in range(12)]
    rows += [(600, None, "user", "Same.")] * 40 + [(601, t, "assistant", "Same.") for t in range(30)]
    return rows + rows[:50]


@pytest.mark.parametrize("sizes", [(512, 64), (3, 2), (0, 1)])
def test_conversations_are_repaired_as_by_hand(spark, monkeypatch, sizes):
    monkeypatch.setattr(conversations.grammar, "__defaults__", sizes)
    rows = talk()
    df = with_clashes(spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING").repartition(4))
    found = conversations.digest(df)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(repaired_by_hand(rows), key=key)
    assert conversations.digest(df.where("false")).isEmpty()


def test_repaired_rows_follow_the_grammar(spark):
    df = spark.createDataFrame(talk(), "conv_id LONG, turn LONG, role STRING, text STRING")
    rows = conversations.damaged(df)
    verdicts = conversations.judged(rows)
    lines = defaultdict(list)
    for r in conversations.repaired(rows, verdicts).collect():
        lines[r.conv_id].append((r.place, r.edit, r.role))
    for v in verdicts.collect():
        mine = sorted(lines[v.conv_id])
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, _, role in mine))
        assert "".join(e for _, e, _ in mine) == v.audit.replace("D", "")


def test_rules_share_matrices_and_ropes_compare_like_strings():
    rng = random.Random(2)
    symbols = conversations.SOUND + conversations.CUT + conversations.BLANK + conversations.COPY
    rules = ("ua", chr(conversations.FIRST_RULE) * 2, "uu", chr(conversations.FIRST_RULE + 1) * 2)
    for n in (0, 1, 5, 300, 5000):
        s = "".join(rng.choices(symbols + "uaua" * 20, k=n))
        assert conversations.cheapest(s, rules) == conversations.cheapest(s, ())
    for _ in range(300):
        a, b = ("".join(rng.choices("DIKR", [9, 1, 1, 1], k=80)) for _ in range(2))
        ropes = [conversations.joined(conversations.joined(x[:k], x[k:50]), x[50:]) for x in (a, b) for k in (rng.randrange(1, 50),)]
        assert [conversations.flat(r) for r in ropes] == [a, b]
        assert conversations.before(*ropes) == (a < b)


# Shards


def sharded_texts():
    rng = random.Random(4)
    data = [(i, "".join(rng.choices("abc é日", k=rng.randrange(0, 400)))) for i in range(3000)]
    for c in range(60):
        copy = f"copy {c} " * rng.randrange(1, 40)
        data += [(10_000 + 100 * c + i, copy) for i in range(rng.randrange(2, 40))]
    data += [(50_000 + i, "hot text " * 20) for i in range(2500)]
    data += [(None, "no id"), (None, "no id"), (7, "again"), (7, "again"), (8, None), (9, None), (9, ""), (60_000, "long " * 5000)]
    return data


def test_shards_are_even_and_keep_copies_together(spark):
    data = sharded_texts()
    df = with_clashes(spark.createDataFrame(data, "doc_id LONG, text STRING").repartition(5))
    out = sharding.sharded(df)
    rows = out.collect()
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in data)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    slots, load = defaultdict(list), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
    assert sorted(load) == list(range(16))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    mean = sum(load.values()) / 16
    assert max(abs(x - mean) for x in load.values()) <= 0.01 * mean
    text = {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())): t or "" for i, t in data}
    met = defaultdict(set)
    for r in rows:
        met[text[r.doc_id, r["size"], r.text_crc32]].add(r.shard)
    hot = sum(len(t) + 1 for _, t in data if t and t.startswith("hot")) / mean
    assert len(met["hot text " * 20]) <= math.ceil(hot / sharding.FILL) + 2
    assert sum(len(s) > 1 for t, s in met.items() if not t.startswith("hot")) <= 2
    assert sorted(map(tuple, sharding.sharded(df).collect()), key=key) == sorted(map(tuple, rows), key=key)


def test_shards_of_few_and_of_no_documents(spark):
    few = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "doc_id LONG, text STRING")
    assert sorted(r["size"] for r in sharding.sharded(few).collect()) == [1, 2, 2]
    assert sharding.sharded(few.where("false")).isEmpty()
    only_copies = spark.createDataFrame([(i, "same") for i in range(1600)], "doc_id LONG, text STRING")
    assert set(Counter(r.shard for r in sharding.sharded(only_copies).collect()).values()) <= set(range(95, 106))


def test_running_sums_chain_pieces(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE", 10)
    df = spark.range(500).select("id", F.col("id").alias("row"), (F.col("id") % 3).alias("g"), F.xxhash64("id").alias("h"), (F.col("id") % 7).alias("v"))
    rows = sharding.running(df, ["g"], "h", "v", 500, "before").collect()
    for g in range(3):
        upto = 0
        for r in sorted((r for r in rows if r.g == g), key=lambda r: r.h):
            assert r.before == upto
            upto += r.v


def test_quotas_swap_and_respect_room():
    share = sharding.quotas({(0, 1): 100, (1, 0): 40, (2, 1): 60}, [100, 100, 100], 130)
    assert share[1, 0] == 1
    assert 100 * share[0, 1] + 60 * share[2, 1] - 40 <= 30.001
