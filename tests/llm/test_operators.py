"""The training-data operators on small tables: nulls, empty and long texts, ties, repeats, extra columns."""

import random
import re
import zlib
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from locusframe.llm import (
    components,
    decontamination,
    graphsearch,
    ngramjoin,
    packing,
    quality,
    sharding,
    suffixarray,
    tokencount,
    toxicity,
    urlrules,
)

SCHEMA = "doc_id long, text string, source string, score double, shard int, _row string, `a.b` int"


def documents(spark, texts, ids=None):
    rows = [(i, t, None if i == 0 else f"s{i % 3}", 0.5, 9, "x", 1) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(chance, n):
    return " ".join("".join(chance.choice(["an", "ber", "co", "di", "el", "for"]) for _ in range(chance.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(4)
    base, passage, long = prose(chance, 80), prose(chance, 60), prose(chance, 6000)
    near = base.split()
    near[40] = "changed"
    return [base, base, " ".join(near), None, "", "  \n", "one", "one", passage + " " + prose(chance, 30), prose(chance, 40) + " " + passage, long, "ünïcode ßtraße 漢字 😀"]


def test_token_counts_match_the_library(spark, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    odd = [*texts, "a  b", " x ", "<|endoftext|> a<|endoftext|>", "it's 'll\r\n\r\n  end", "\x1c ý"]
    found = tokencount.token_counts(documents(spark, odd), path).select("doc_id", "n_bytes", "n_tokens", "`a.b`").collect()
    for row in found:
        text = odd[row["doc_id"]] or ""
        assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), len(library.encode(text, add_special_tokens=False).ids))
    assert tokencount.token_counts(documents(spark, []), path).count() == 0


def test_merging_takes_the_lowest_rank_first():
    ranks = {(1, 2): (1, 4), (2, 3): (0, 5), (1, 5): (2, 6), (7, 7): (3, 8)}
    assert tokencount.merges_made([1, 2, 3], ranks) == 2
    assert tokencount.merges_made([7, 7, 7], ranks) == 1
    assert tokencount.merges_made([], ranks) == tokencount.merges_made([3], ranks) == 0


def test_packing_is_an_exact_round_trip(spark, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    many = texts * 3
    rows = packing.pack(documents(spark, many, [i // 2 for i in range(len(many))]), path, size=256, block=12).collect()
    sequences = {}
    for row in rows:
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in pairwise(parts))
        assert sum(n for _, n in parts) <= 256
    wanted = []
    for i, text in enumerate(many):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 256)):
            part = ids[start : start + 256]
            wanted.append((i // 2, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(wanted)
    assert packing.pack(documents(spark, []), path).count() == 0


def test_genetic_steps_keep_every_piece():
    chance = random.Random(2)
    lengths = np.array([chance.randint(1, 99) for _ in range(200)])
    block = packing.Block(lengths, 100)
    people = block.evolve([block.first(chance, bool(i)) for i in range(3)], chance, 5, 3)
    for bins in people:
        assert (bins >= 0).all() and np.bincount(bins, lengths).max() <= 100
    assert block.count(people[0]) <= 1.1 * block.least


def test_interleaving_matches_the_mixture(spark):
    frame = spark.range(1000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 600, "hot").when(F.col("id") < 990, "cold").alias("source"), F.lit(1).alias("shard")
    )
    rows = sharding.interleave(frame.union(frame.limit(0)), 7, ranges=5).collect()
    other = sharding.interleave(frame, 7, ranges=1).collect()
    assert sorted(rows) == sorted(other)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
    sizes = [len(v) for v in by_shard.values()]
    assert len(by_shard) == 7 and max(sizes) - min(sizes) <= 1
    for v in by_shard.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
        assert abs(sum(r["source"] == "hot" for r in v) - 0.6 * len(v)) <= 2
    assert sharding.interleave(frame.limit(0), 3).count() == 0


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://EXAMPLE.net/en/x?a#b", "https://a.example.net/de/", "http://m.b.org/x", "https://b.org/q?page=2&ref=x", "https://b.org/q?page=2&ref=x", "https://xnet/", "https://c.de/x.html?page=2"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    site = (("block", "net/"), ("allow", "example.net/en/"), ("allow", "org/fr/"))
    rows = {r["page_id"]: r for r in urlrules.judge(pages, site, urlrules.DEFAULT_RULES).collect()}
    assert len(rows) == len(urls)
    assert [rows[i]["host"] for i in (0, 1, 2)] == ["", "", ""]
    assert (rows[3]["host"], rows[3]["path"], rows[3]["rule"], rows[3]["verdict"]) == ("example.net", "/en/x", "example.net/en/", "allow")
    assert (rows[4]["rule"], rows[4]["verdict"]) == ("net/", "block")
    verdicts = ["block" if re.search(r"\Ahttp://m\.|[?]page=2(&|$)|&ref=x$", u or "") else "allow" for u in urls]
    assert all(rows[i]["verdict"] == verdicts[i] for i in (5, 6, 7, 8, 9))
    assert urlrules.judge(pages.limit(0), site, urlrules.DEFAULT_RULES).count() == 0


def test_restoration():
    model = np.zeros((toxicity.SYMBOLS,) * 3) - 3.0
    for word in ("loser", "idiot", "stupid"):
        codes = [0, 0, *(toxicity._CODES[c] for c in word), 0]
        for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
            model[a, b, c] = -0.1
    restorer = toxicity.Restorer(model)
    for written, word in (("l0$er", "loser"), ("1d10t", "idiot"), ("s.t.u.p.i.d", "stupid"), ("stuuuupid", "stupid"), ("loser,", "loser")):
        assert word in restorer.words(written)
    assert restorer.spaced("a l o s e r") and restorer.words("2024") == ()


def test_restoration_of_signs_at_the_end_and_repeated_letters():
    model = np.zeros((toxicity.SYMBOLS,) * 3) - 3.0
    for word in ("dumbass", "ass", "idiot", "stupid"):
        codes = [0, 0, *(toxicity._CODES[c] for c in word), 0]
        for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
            model[a, b, c] = -0.1
    restorer = toxicity.Restorer(model)
    written = {"dumba$$!": "dumbass", "idio+!": "idiot", "4$$": "ass", "455": "ass", "stuupid": "stupid", "iidiot": "idiot", "idiot!!!": "idiot", "dumbass": "dumbass"}
    assert {w: restorer.words(w) for w in written} == {w: (r,) for w, r in written.items()}
    assert restorer.words("a$$$")[0].startswith("ass")
    assert restorer.words("!!") == restorer.words("2024") == restorer.words("--") == ()
    assert restorer.spaced("x\ni\nd\ti\n\no     t\n") and "idiot" in restorer.spaced("i\nd\ti\n\no     t\n")


def test_scores(spark, texts):
    chance = random.Random(8)
    good = [prose(chance, 40) for _ in range(60)]
    bad = [prose(chance, 20) + " vilename " + prose(chance, 20) for _ in range(30)]
    frame = documents(spark, [*good, *bad, *texts, "v1l3name " + prose(chance, 9)])
    labels = spark.createDataFrame([(i, int(i < 60), int(60 <= i < 90)) for i in range(90)], "doc_id long, quality int, toxic int")
    scored = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(frame, frame, labels).select("doc_id", "score").collect()}
    assert all(scored[i] < 0.5 for i in range(60)) and all(scored[i] >= 0.5 for i in range(60, 90))
    assert scored[90 + len(texts)] >= 0.5 and all(0 <= s <= 1 for s in scored.values())
    junk = documents(spark, [*good, *[(w + "!! ") * 30 for w in ("THE", "AND", "OF")] * 10, *texts])
    ranked = {r["doc_id"]: r["score"] for r in quality.score_quality(junk, junk, labels).select("doc_id", "score").collect()}
    assert all(ranked[i] > 0.3 for i in range(60)) and all(ranked[i] <= 0.31 for i in range(60, 90))
    assert quality.score_quality(junk, junk, labels.limit(0)).select("score").distinct().count() == 1


def test_graph_search_on_ties_and_unusable_vectors(spark):
    chance = np.random.default_rng(5)
    vectors = [v.tolist() for v in chance.normal(size=(400, 8)).astype(np.float32)]
    vectors += [vectors[0]] * 60 + [None, [0.0] * 8, [float("nan")] * 8, [None] * 8]
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int")
    rows = graphsearch.nearest(frame, F.col("vec_id") % 20 == 0, k=5, least_shards=2).collect()
    usable = {i: np.array(v, np.float64) for i, v in enumerate(vectors[:460])}
    hits = 0
    for q in range(0, 460, 20):
        truth = sorted(((-float(np.dot(v, usable[q])), i) for i, v in usable.items() if i != q))[:5]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in rows if r["query_id"] == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        hits += len({i for _, i in truth} & {m[1] for m in mine})
    assert hits >= 0.9 * 5 * 23 and {r["query_id"] for r in rows} == set(range(0, 460, 20))
    assert graphsearch.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def brute_components(texts, n, percent):
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    name = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(len(texts)):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    name[a] = name[b] = min(name[a], name[b])
    return [(i, len(s), c) for i, (s, c) in enumerate(zip(sets, name, strict=True))]


def test_ngram_join_equals_brute_force(spark, texts):
    chance = random.Random(6)
    base = prose(chance, 120).split()
    many = list(texts)
    for _ in range(25):
        words = list(base)
        for _ in range(chance.randint(0, 5)):
            words[chance.randrange(len(words))] = prose(chance, 1)
        many.append(" ".join(words))
    found = ngramjoin.near_duplicates(documents(spark, many), 4, 85).collect()
    assert sorted(map(tuple, found)) == brute_components(many, 4, 85)
    assert ngramjoin.near_duplicates(documents(spark, []), 4, 85).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (None, 3), (60, 50), (50, 60)]
    rows = components.components(spark.createDataFrame(chain, "u long, v long")).collect()
    assert dict(map(tuple, rows)) == {i: 0 for i in range(41)} | {50: 50, 60: 50}


def test_components_over_many_tasks(spark, monkeypatch):
    chance = random.Random(12)
    chain = [(i, i + 1) for i in range(400)] + [(1000 + chance.randrange(300), 1000 + chance.randrange(300)) for _ in range(140)]
    chain += [(5000, 5000 + i) for i in range(1, 200)]
    chance.shuffle(chain)
    name = {x: x for edge in chain for x in edge if edge[0] != edge[1]}
    for _ in range(402):
        for u, v in chain:
            if u != v:
                name[u] = name[v] = min(name[u], name[v])
    monkeypatch.setattr(components, "LOCAL_NODES", 10)
    frame = spark.createDataFrame(chain, "u long, v long").repartition(16)
    assert dict(map(tuple, components.components(frame).collect())) == name
    assert components.components(frame.limit(0)).count() == 0


def test_suffix_order():
    chance = random.Random(3)
    for _ in range(2000):
        text = [chance.randint(0, chance.choice([0, 1, 3])) for _ in range(chance.randint(0, 15))]
        assert suffixarray.suffix_order(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_repeated_bytes_equal_brute_force(spark, texts):
    many = [*texts, "ab" * 300, texts[8][:350], "x" + texts[8][10:215]]
    rows = {r["doc_id"]: r for r in suffixarray.removal_digest(documents(spark, many), 200).collect()}
    data = [(t or "").encode() for t in many]
    seen = {}
    for b in data:
        for i in range(len(b) - 199):
            seen[b[i : i + 200]] = seen.get(b[i : i + 200], 0) + 1
    for i, b in enumerate(data):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 199):
            if seen[b[s : s + 200]] > 1:
                gone[s : s + 200] = True
        assert (rows[i]["n_bytes"], rows[i]["n_removed"]) == (len(b), int(gone.sum()))
        assert rows[i]["n_spans"] == int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
    assert suffixarray.removal_digest(documents(spark, []), 200).count() == 0


def test_repeated_bytes_of_a_frequent_gram(spark, monkeypatch):
    chance = random.Random(14)
    footer, part = prose(chance, 60)[:130], prose(chance, 60)[:120]
    many = [prose(chance, 60) + footer + prose(chance, 60) for _ in range(60)]
    many += [prose(chance, 40) + part[chance.randrange(60) :] + footer + part[: chance.randrange(120)] + prose(chance, 40) for _ in range(60)]
    many += [many[3], many[70], footer + part, part + footer, "ab" * 400, "ab" * 150 + "c" + "ab" * 150]
    rows = documents(spark, many)
    spans_of_block = suffixarray._spans_of_block

    def bounded(length, gram):
        run = spans_of_block(length, gram)

        def checked(frame):
            assert frame.groupby("h").size().max() <= 2
            return run(frame)

        return checked

    monkeypatch.setattr(suffixarray, "_spans_of_block", bounded)
    spans = suffixarray.repeated_spans(rows, 200, contexts_per_block=20)
    found = {r["text"]: r["found"] for r in suffixarray.per_text(rows, spans, lambda data, f: (data.decode(), f), "text string, found array<struct<a:int,b:int>>").collect()}
    data, starts = [t.encode() for t in many], {}
    for b in data:
        for i in range(len(b) - 199):
            starts[b[i : i + 200]] = starts.get(b[i : i + 200], 0) + 1
    for text, b in zip(many, data, strict=True):
        wanted = suffixarray.united([(i, i + 200) for i in range(len(b) - 199) if starts[b[i : i + 200]] > 1], len(b))
        assert [tuple(f) for f in found.get(text, [])] == wanted
    assert any(found.values())


def test_repeated_bytes_of_heavy_grams_and_contexts(spark):
    chance = random.Random(15)
    footer = prose(chance, 60)[:130]
    shared = prose(chance, 60)[:110] + footer + prose(chance, 60)[:110]
    # Two grams with over 1,000 rows: one whose contexts all differ, and one where most are equal.
    many = [prose(chance, 30)[:110] + footer + prose(chance, 30)[:110] for _ in range(1100)]
    many += [f"{i:05d}" + shared + f"{i:05d}" for i in range(1100)]
    rows = suffixarray.removal_digest(documents(spark, many), 200).select("n_bytes", "n_removed").collect()
    data, starts = [t.encode() for t in many], {}
    for b in data:
        for i in range(len(b) - 199):
            starts[b[i : i + 200]] = starts.get(b[i : i + 200], 0) + 1
    wanted = []
    for b in data:
        spans = suffixarray.united([(i, i + 200) for i in range(len(b) - 199) if starts[b[i : i + 200]] > 1], len(b))
        wanted.append((len(b), sum(e - a for a, e in spans)))
    assert sorted(map(tuple, rows)) == sorted(wanted)


def test_leaks(spark, texts):
    chance = random.Random(9)
    items = [(i, prose(chance, 20) + ".\n" + prose(chance, 8)) for i in range(30)] + [(90, None), (91, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    leaky = [prose(chance, 50) + " " + items[7][1] + " " + prose(chance, 200), items[3][1].upper(), items[5][1].split(".")[0]]
    frame = documents(spark, [*texts, *leaky])
    for part in (500, 7):
        rows = decontamination.find_matches(frame, bench, items_per_part=part).select("doc_id", F.inline("matches")).collect()
        assert {(r["doc_id"], r["item_id"]) for r in rows} == {(len(texts), 7), (len(texts) + 1, 3)}
    assert decontamination.find_matches(frame, bench.limit(0)).filter(F.size("matches") > 0).count() == 0
