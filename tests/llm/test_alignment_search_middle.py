"""Alignment of tokenizers, exact search and fill-in-middle against brute force, on small tables with odd rows."""

import hashlib
import json
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from locusframe.llm import alignment, fillmiddle, kdtree
from locusframe.llm.tokencount import byte_symbols

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def prose(chance, n):
    return " ".join(chance.choice(["river", "Über", "naïve", "token", "a", "漢字", "x1", "don't", "stop."]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(5)
    odd = [None, "", " ", "one", "one", "  two  blanks ", "tab\there", "line\n\nbreak", "▁ sign", "<|endoftext|> a</s><unk>", "😀é", "\x00z"]
    return [*odd, *(prose(chance, chance.randint(1, 60)) for _ in range(40)), prose(chance, 900), "q" * 5000]


def documents(spark, texts, ids=None):
    rows = [(i, t, 1, "x", 7) for i, t in zip(range(len(texts)) if ids is None else ids, texts, strict=True)]
    return spark.createDataFrame(rows, "doc_id long, text string, n int, form string, `a.b` int")


def aligned_by_hand(rows):
    """(documents, links of pairs, documents of pairs), token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    value = {c: i for i, c in enumerate(byte_symbols())}
    name = {i: t for t, i in one.get_vocab().items()}
    out, links_of, docs_of = [], Counter(), Counter()
    for doc, text in rows:
        data = (" " + (text or "")).encode()
        a = one.encode(data.decode(), add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        pieces = [
            [bytes(value[c] for c in name[i]) for i in a],
            [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b],
        ]
        if any(b"".join(p) != data for p in pieces):
            a, b, pieces = [], [], [[], []]
        ends = [np.cumsum([0, *map(len, p)]).tolist() for p in pieces]
        links = [
            (a[i], b[j])
            for i in range(len(a))
            for j in range(max(0, np.searchsorted(ends[1], ends[0][i]) - 1), len(b))
            if ends[1][j] < ends[0][i + 1]
            if max(ends[0][i], ends[1][j]) < min(ends[0][i + 1], ends[1][j + 1])
        ]
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0][1:]) & set(ends[1][1:])):
            p, q = ends[0].index(end), ends[1].index(end)
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        links_of.update(links)
        docs_of.update(set(links))
        out.append((doc, len(a), len(b), links, groups))
    top = {}
    for (_, b), n in links_of.items():
        top[b] = max(top.get(b, 0), n)
    found = [
        (d, na, nb, len(g), len(k), sum(links_of[p] == top[p[1]] for p in k), sum(links_of[p] for p in k), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for d, na, nb, k, g in out
    ]
    return found, links_of, docs_of


def by_text(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize(("docs", "chunk_bytes"), [(8192, 16_000_000), (3, 500)])
def test_alignment_equals_brute_force(spark, texts, docs, chunk_bytes):
    ids = [None, 2**62 + 1, *range(2, len(texts))]
    frame = documents(spark, texts, ids).repartition(3)
    found = alignment.alignment_scores(frame, A, B, chunk_bytes=chunk_bytes, docs=docs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    expected, _, _ = aligned_by_hand(zip(ids, texts, strict=True))
    assert by_text(tuple(r) for r in found.collect()) == by_text(expected)


def test_pair_counts_equal_brute_force(spark, texts):
    chunks = alignment.aligned_chunks(documents(spark, texts).repartition(2), A, B, docs=10)
    _, links, docs = aligned_by_hand(enumerate(texts))
    found = {(r["a"], r["b"]): (r["docs"], r["links"]) for r in alignment.pair_counts(chunks).collect()}
    assert found == {p: (docs[p], links[p]) for p in links}


def test_ids_by_ranks_equal_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        words = alignment.Vocabularies(a.read(), b.read())
    assert words.ranks is not None
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    some = [f" a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2 .{chr(c)}! {chr(c)} \n" for c in points[:: 7]]
    chance = random.Random(2)
    some += ["".join(chance.choice("abcdeéß漢 \n'!.019AB") for _ in range(chance.randint(1, 900))) for _ in range(300)]
    some += ["z" * 20_000, " " * 3000, "<|endoftext|>"]
    assert words.encode_a(some) == [e.ids for e in library.encode_batch_fast(some, add_special_tokens=False)]
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as other:
        assert alignment.rank_encoder(json.load(other)) is None


def test_alignment_of_no_rows_and_repeated_rows(spark):
    assert alignment.alignment_scores(documents(spark, []), A, B).count() == 0
    rows = alignment.alignment_scores(documents(spark, ["same text"] * 3, [1, 1, 1]), A, B).collect()
    assert len(rows) == 3 and len(set(rows)) == 1 and rows[0]["count_sum"] == 3 * rows[0]["n_links"]


def test_planes():
    chance = np.random.default_rng(1)
    pairs, docs = chance.integers(0, 5, 20_000), chance.integers(0, 8192, 20_000) // chance.integers(1, 9, 20_000)
    halves = [alignment.Planes.counted(*alignment.posting_keys(pairs[docs % 2 == i], docs[docs % 2 == i])) for i in (0, 1)]
    planes = alignment.Planes.united(halves)
    names, counts = planes.documents()
    met = Counter(zip(pairs.tolist(), docs.tolist(), strict=True))
    assert counts.tolist() == [sum(p == n for p, _ in met) for n in names.tolist()]
    assert planes.links(names).tolist() == [int((pairs == n).sum()) for n in names.tolist()]
    for some in ([], [0], [8191], range(511), range(512), range(8192)):
        assert alignment.expanded(alignment.compressed(np.array(some, np.int64))).tolist() == list(some)


def vectors(chance, n, dim):
    return [[chance.choice([-1.5, -0.25, 0.0, 0.013, 0.5, 2.0]) * chance.random() for _ in range(dim)] for _ in range(n)]


def found_by_hand(rows, k, every):
    fine = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in fine:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i) for i, w in fine if i != q and len(w) == len(v))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def searched(spark, rows, k=5, every=4, **sizes):
    frame = spark.createDataFrame([(i, v, 9, "x") for i, v in rows], "vec_id long, embedding array<float>, shard int, query string")
    found = kdtree.top_products(frame, F.col("vec_id") % every == 0, k, **sizes)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in found.collect())


def test_exact_search_equals_brute_force(spark):
    chance = random.Random(8)
    rows = list(enumerate(vectors(chance, 300, 3)))
    rows += [(300 + i, rows[4][1]) for i in range(60)]  # copies, many of them queries
    rows += [(400, None), (404, [float("nan"), 1.0, 2.0]), (408, [None, 1.0, 2.0]), (412, [0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(416, [1.0, 2.0]), (417, [2.0, 1.0]), (420, []), (424, [float("inf"), 0.0, 1.0]), (428, [900.0, -900.0, 5.0])]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    expected = found_by_hand(rows, 5, 4)
    assert searched(spark, rows, rows_per_shard=40, leaf_rows=4, queries_per_block=20) == expected
    assert searched(spark, rows, rows_per_shard=3000, sample_rows=64) == expected


def test_exact_search_of_few_or_no_rows(spark):
    assert searched(spark, []) == []
    assert searched(spark, [(0, [1.0])]) == []
    assert searched(spark, [(0, [1.0]), (1, [-1.0])]) == [(0, 1, 1, -4096)]


def test_exact_search_of_very_large_components(spark):
    rows = [(0, [2.0**50, 1.0]), (1, [2.0**50, 1.0]), (2, [2.0**50, 1.015625]), (3, [-(2.0**50), 3.0]), (4, [1.0, 1.0])]
    found = searched(spark, rows, k=4, every=2)
    assert [r[2] for r in found if r[0] == 0] == [2, 1, 4, 3]
    assert [r[3] for r in found if r[0] == 0] == [2**63 - 1, 2**63 - 1, 2**62 + 4096, -(2**63 - 1)]


def test_boxes_bound_and_prune():
    chance = np.random.default_rng(3)
    points = np.concatenate([chance.integers(-5, 5, (400, 6)) + 100 * c for c in chance.integers(-3, 4, (20, 6))])
    tree = kdtree.build(points, 16)
    ordered = points[tree.order]
    for node in range(len(tree.first)):
        rows = ordered[tree.first[node] : tree.last[node]]
        assert (rows.min(0) == tree.low[node]).all() and (rows.max(0) == tree.high[node]).all()
    asked = points[::97]
    limits = kdtree.bounds(tree, asked)
    for node in range(len(tree.first)):
        assert (limits[:, node] >= (ordered[tree.first[node] : tree.last[node]] @ asked.T).max(0)).all()
    members = [np.array([i]) for i in tree.order]
    opened = [n for _, _, n in kdtree.search(tree, ordered, members, asked, 5, [None] * len(asked))]
    assert max(opened) < (tree.left < 0).sum() / 3


def middle_by_hand(doc, text, seed=42):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    form = "spm" if h[3] % 100 < 80 else "psm"
    return n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def test_fill_in_middle_equals_brute_force_and_goes_back(spark, texts):
    many = [*texts, "a <P> b", "<S>", "< P >", "<P<S", *texts, "　wide space", "\x1c\x85"]
    ids = [None, *range(1, len(many))]
    rows = fillmiddle.restore(fillmiddle.fill_in_middle(documents(spark, many, ids))).collect()
    assert len(rows) == len(many)
    forms = set()
    for row in rows:
        text = many[row["doc_id"] or 0]
        expected = middle_by_hand(row["doc_id"], text)
        assert (row["n"], row["form"], row["prefix_chars"], row["middle_chars"], bytes(row["output"]).decode()) == expected
        assert bytes(row["restored"]).decode() == (text or "") and row["a.b"] == 7
        forms.add(row["form"])
    assert forms == {"plain", "psm", "spm"}
    assert fillmiddle.restore(fillmiddle.fill_in_middle(documents(spark, []))).count() == 0


def test_rotations_go_back():
    chance = random.Random(6)
    for _ in range(2000):
        data = bytes(chance.choice(b"ab <>PSM\n") for _ in range(chance.randint(1, 30)))
        if any(m in data for m in (b"<P>", b"<S>", b"<M>")):
            continue
        low, high = sorted(chance.choice([0, *fillmiddle.unit_ends(data).tolist()]) for _ in range(2))
        for form in ("psm", "spm"):
            assert fillmiddle.restored_text(bytes(fillmiddle.transformed(data, low, high, form)), form) == data
    long = random.Random(7).randbytes(300_001)
    buffer = bytearray(long)
    fillmiddle.rotate(buffer, 7, 100_000, 300_000)
    assert bytes(buffer) == long[:7] + long[100_000:300_000] + long[7:100_000] + long[300_000:]
    with pytest.raises(ValueError, match="no output"):
        fillmiddle.restored_text(b"<P>a<M>b", "psm")
