"""Tokenizer alignment, vector codes and source mixing against plain Python versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pagefeatures.llm import alignment, mixing, queries, vector_codes

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "\n", "a ", " a", "a  b\n c", "x\n\ny z", "One two, three. One two!", "ÀÉ Straße ΑΣ é ﬁ 日本 😀 don't 12ab",
    "x<|endoftext|>y <s> </s> <unk> <0x41>", "has ▁ a mark", "\x00 nul \x00", "a\u000bb\x0cc\x1cd\x85e　f", "a  b   c", "tab\t x \t",
    "word " * 3000, "z" * 5000, "One two, three. One two!", "é combining", "﻿bom", "\U0010ffff end",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{i % 4}" if i % 7 else None, "clash", 1) for i, t in enumerate(TEXTS)]
    rows += [(2, "a  b\n c", "s1", None, None), (2, "a  b\n c", "s1", "x", 2), (None, "no id at all", "s2", "c", 3), (None, None, "", "c", 4)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, chunk string, size int").repartition(3).cache()


def aligned(texts):
    """(n_a, n_b, groups) of each text by the libraries and plain sets of byte offsets, and its linked pairs."""
    tool = Tokenizer.from_file(A_PATH)
    tool.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    to_byte = {c: b for b, c in enumerate(alignment.byte_alphabet())}
    out = []
    for text in texts:
        a = tool.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        a_bytes = [bytes(to_byte[c] for c in tool.id_to_token(i)) for i in a]
        b_bytes = []
        for p in map(pieces.id_to_piece, b):
            b_bytes.append(bytes.fromhex(p[3:5]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode())
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode() or not text:
            out.append((0, 0, "", []))
            continue
        ends = [np.cumsum([len(t) for t in x]).tolist() for x in (a_bytes, b_bytes)]
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups, links, at = [], [], [0, 0]
        for e in shared:
            to = [x.index(e) + 1 for x in ends]
            groups.append(",".join(map(str, a[at[0]:to[0]])) + "|" + ",".join(map(str, b[at[1]:to[1]])))
            links.append((a[to[0] - 1], b[to[1] - 1]))
            at = to
        out.append((len(a), len(b), ";".join(groups), links))
    return out


def expected_alignment(rows):
    found = aligned([t or "" for _, t in rows])
    count = Counter(p for *_, links in found for p in links)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(i, na, nb, len(links), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), groups)
            for (i, _), (na, nb, groups, links) in zip(rows, found)]


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


# 11 ----------------------------------------------------------------------------------------------------------------
def test_alignment(docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected_alignment(rows)
    got = [tuple(r) for r in alignment.align_tokenizers(docs, A_PATH, B_PATH).collect()]
    same(got, want)
    digests = [tuple(r) for r in alignment.align_tokenizers(docs, A_PATH, B_PATH, keep_groups=False).collect()]
    same(digests, [(*w[:7], w[7] and hashlib.sha256(w[7].encode()).hexdigest()) for w in want])


def test_alignment_over_many_chunks(docs, spark):
    """Counts go back to every chunk: here one for nearly each document."""
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(100 + k, f"One two, three {k % 5}. <{k}>") for k in range(60)]
    many = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    same([tuple(r) for r in alignment.align_tokenizers(many, A_PATH, B_PATH).collect()], expected_alignment(rows))


def test_alignment_query_and_empty(spark, docs):
    got = queries.QUERIES["op11_tokenizer_alignment"](spark, "/root/testdata/sf0.001").collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = [(*w[:7], w[7] and hashlib.sha256(w[7].encode()).hexdigest()) for w in expected_alignment(rows)]
    same([tuple(r) for r in got], want)
    assert alignment.align_tokenizers(docs.where("false"), A_PATH, B_PATH).collect() == []


def test_alignment_blocks_and_long_text():
    """Blocks of any size, and the packed codes, give the same."""
    tool = alignment.two_tokenizers(A_PATH, B_PATH)
    texts = pa.array([t or "" for t in TEXTS])
    whole = alignment.align(tool, texts)[0].to_pylist()
    assert whole == [r for k in range(len(texts)) for r in alignment.align(tool, texts.slice(k, 1))[0].to_pylist()]
    codes = np.array([0, 5, 70_000, 1 << 30])
    assert alignment.unpack_codes(alignment.pack_codes(codes), 4).tolist() == codes.tolist()
    assert alignment.unpack_codes(alignment.pack_codes(codes[:0]), 0).tolist() == []


def test_alignment_links_of_a_chunk():
    """Between blocks a link takes four bytes; the pairs stand by count, then by ids."""
    links, count, want = alignment.Links(), Counter(), []
    pick = random.Random(5)
    for size in (0, 900, 1, 3000, 0):
        pairs = [(int(pick.expovariate(0.1)), pick.randrange(6)) for _ in range(size)]
        links.add(pa.table({"a": pa.array([a for a, _ in pairs], pa.int32()), "b": pa.array([b for _, b in pairs], pa.int32())}))
        count.update(pairs)
        want.append(pairs)
    assert sum(x.nbytes for x in links.blocks) == 4 * 3901
    a, b, n, rank = links.by_count()
    listed = list(zip(a.tolist(), b.tolist()))
    assert list(zip(listed, n.tolist())) == sorted(count.items(), key=lambda x: (-x[1], x[0]))
    assert [[listed[k] for k in rank[codes]] for codes in links.blocks] == want


def test_alignment_holds_small_batches(spark, monkeypatch):
    """The tokenizing tasks get batches bounded in bytes, and texts longer than a batch or a block stay whole."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen, real = spark.conf.get(name), [], alignment.stored
    monkeypatch.setattr(alignment, "stored", lambda df, table: seen.append(spark.conf.get(name)) or real(df, table))
    rows = [(k, f"some words {k} and more. " * (100_000 if k == 2 else 20_000)) for k in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.groups for r in alignment.align_tokenizers(df, A_PATH, B_PATH).select("doc_id", "groups").collect()}
    assert seen == ["2m"] and spark.conf.get(name) == before
    tool = alignment.two_tokenizers(A_PATH, B_PATH)
    assert got == {k: alignment.align(tool, pa.array([t]))[0]["groups"][0].as_py() for k, t in rows}


# 12 ----------------------------------------------------------------------------------------------------------------
def brute_codes(rows, parts=4, entries=256, rounds=4):
    """(sorted (id, code, error, label_error), codebooks text) with loops over whole numbers."""
    kept = [(i, v, k) for i, v, k in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    ints = [[int(np.floor(np.float64(x) * 1024)) for x in v] + [0] * (-len(v) % parts) for _, v, _ in kept]
    width = len(ints[0]) // parts
    cut = [[v[p * width:p * width + width] for p in range(parts)] for v in ints]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, p):
        d = [sum((a - b) ** 2 for a, b in zip(x, y)) for y in books[p]]
        return min(range(len(d)), key=lambda k: (d[k], k)), min(d)

    for _ in range(rounds):
        member = defaultdict(list)
        for c in cut:
            for p in range(parts):
                member[p, nearest(c[p], p)[0]].append(c[p])
        for (p, e), xs in member.items():
            books[p][e] = [sum(col) // len(xs) for col in zip(*xs)]
    coded = [[nearest(c[p], p) for p in range(parts)] for c in cut]
    errors = [sum(d for _, d in c) for c in coded]
    label = Counter()
    for (_, _, k), e in zip(kept, errors):
        label[k] += e
    return ([(i, "".join(f"{x:02x}" for x, _ in c), e, label[k]) for (i, _, k), c, e in zip(kept, coded, errors)],
            ",".join(str(x) for p in books for y in p for x in y))


def test_vector_codes(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(8)], i % 3 if i % 5 else None) for i in range(60)]
    rows += [(i, [0.5] * 8, 1) for i in range(60, 90)]  # copies, ties
    rows += [(90, None, 1), (91, [], 1), (92, [1.0, None] * 4, 1), (93, [float("nan")] * 8, 1), (94, [float("inf")] * 8, 2),
             (None, [-0.0001] * 8, 7), (3, [1.0] * 8, 0), (95, [1.0] * 5, 0), (96, [60_000.25, -60_000.5] * 4, 9)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<double>, label int, codes string, error int")
    for entries, rounds in ((7, 4), (256, 1)):
        got, books = vector_codes.compress(df.repartition(5), entries=entries, rounds=rounds)
        want, text = brute_codes(rows, entries=entries, rounds=rounds)
        same([(r.vec_id, r.codes.hex(), r.error, r.label_error) for r in got.collect()], want)
        assert vector_codes.codebook_text(books) == text
    odd = df.where("vec_id = 95")  # five components in four parts
    got, books = vector_codes.compress(odd)
    assert [(r.codes.hex(), r.error) for r in got.collect()] == [("00000000", 0)] and books.shape == (4, 1, 2)
    got, books = vector_codes.compress(df.where("vec_id = 90"))
    assert got.collect() == [] and vector_codes.codebook_text(books) == ""


def test_vector_tables_by_dictionary():
    rng = np.random.default_rng(1)
    for top in (50, 1 << 25):
        ints, books = rng.integers(-top, top, (300, 12)), rng.integers(-top, top, (3, 9, 4))
        index, best = vector_codes.nearest(ints, books)
        d = ((ints.reshape(300, 3, 1, 4) - books[None]) ** 2).sum(axis=3)
        assert (index == d.argmin(axis=2)).all() and (best == d.min(axis=2)).all()


# 13 ----------------------------------------------------------------------------------------------------------------
def brute_targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2), cap=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, free = {}, set(order)
    left = share * sum(sizes.values())
    while free:
        per = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * per > cap * sizes[s]}
        if not above:
            return target | {s: weight[s] * per for s in free}
        for s in above:
            target[s] = Fraction(cap * sizes[s])
            left -= target[s]
        free -= above
    return target


def check_mix(df, rows, near=0.02):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r.source] += words(r.text)
    want = brute_targets({r.source: sizes[r.source] for r in rows})
    got = df.collect()
    same([(r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got],
         [(r.doc_id, words(r.text), sizes[r.source], round(float(want[r.source]), 6)) for r in rows])
    by_size = {(sizes[s], round(float(t), 6)): s for s, t in want.items()}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[by_size[r.source_size, round(r.target, 6)]] += r.taken
    if len(by_size) == len(want):
        for s, t in want.items():
            assert abs(taken[s] - t) <= max(near * t, 2), (s, taken[s], float(t))
    return got


def test_mix(docs, spark):
    rows = docs.collect()
    got = check_mix(mixing.mix(docs), rows)
    same([tuple(r) for r in got], [tuple(r) for r in mixing.mix(docs.repartition(7)).collect()])  # whatever the partitions
    assert mixing.mix(docs.where("false")).collect() == []
    assert all(r.taken == 0 for r in mixing.mix(docs.where("text = '' OR text IS NULL")).collect())


def test_mix_sources(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 400), "hot" if i % 3 == 0 else f"é{i % 23}") for i in range(900)]
    rows += [(i, "one two three", "tiny") for i in range(3)] + [(7, "copy " * 50, "copies")] * 200 + [(8, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_mix(mixing.mix(df, shard_words=2000), df.collect())


def test_mix_query(spark):
    got = check_mix(queries.QUERIES["op13_source_mix"](spark, "/root/testdata/sf0.001"),
                    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect())
    assert abs(sum(r.taken for r in got) - 1.5 * sum(r.size for r in got)) <= 0.01 * sum(r.size for r in got)


def plain_seats(votes, seats, most):
    got = [0] * len(votes)
    for _ in range(seats):
        open_ = [k for k, v in enumerate(votes) if v and got[k] < most[k]]
        if not open_:
            break
        got[max(open_, key=lambda k: (Fraction(votes[k], 2 * got[k] + 1), -k))] += 1
    return got


def test_highest_quotients():
    rng = random.Random(1)
    for _ in range(200):
        votes = [rng.choice([0, 5, 5, rng.randint(1, 1000)]) for _ in range(rng.randint(1, 12))]
        most = [rng.choice([1 << 40, rng.randint(0, 30)]) for _ in votes]
        seats = rng.randint(0, 80)
        assert mixing.highest_quotients(votes, seats, most) == plain_seats(votes, seats, most)


def test_source_blocks_by_divisor(spark):
    """The divisor found by sums gives the seats of the highest quotients, ties by position included."""
    rng = random.Random(2)
    for case in range(4):
        votes = [[10] * 9, [3, 3, 3, 1, 1, 100], [rng.randint(1, 10_000) for _ in range(40)], [0, 0, 7]][case]
        df = spark.createDataFrame([(float(v), k) for k, v in enumerate(votes)], "target double, position long")
        for seats in (1, 4, 13, 200):
            got = [r[0] for r in df.orderBy("position").select(mixing.source_blocks(df, seats)).collect()]
            assert got == plain_seats(votes, seats, [1 << 40] * len(votes))
