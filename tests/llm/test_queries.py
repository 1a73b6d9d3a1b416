"""Registered queries and pipeline stages against plain Python versions."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import (BYTE, WORD, base_spans, plain_battery, plain_fingerprint, plain_groups, plain_measures, same, texts_of)
from tokenizers import Tokenizer

from pagefeatures.llm import quality_rules, queries, secret_scan, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def some(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pieces_of(texts, capacity=4096):
    tool, out = Tokenizer.from_file(WORD), []
    for i, t in texts:
        ids = [*tool.encode(t, add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            cut = ids[a:a + capacity]
            out.append((i, k, a, len(cut), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))))
    return out


def check_packed(rows, texts):
    same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], pieces_of(texts))
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= -(-sum(r.length for r in rows) // 4096) + 2


def test_op1(spark, some):
    rows = queries.QUERIES["op1_importance_resampling"](spark, SF).collect()
    labels = [r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality IS NOT NULL").collect()]
    share = sum(q == 1 for q in labels) / len(labels)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in some.collect())
    kept = [r.sample_key for r in rows if r.kept]
    assert abs(len(kept) - share * len(rows)) <= 1 and min(kept) >= max(r.sample_key for r in rows if not r.kept) - 1e-9


def plain_scan(spark, texts):
    """Counts, digest and the whole spans string of every text; the battery's p-values decide with corpus-wide limits."""
    bins, tested = defaultdict(Counter), []
    for i, t in texts:
        base = base_spans(t)
        runs = [(m.start(), m.end(), m.group().rstrip("=")) for m in re.finditer(secret_scan.RUN, t) if re.search("[A-Za-z]", m.group())]
        tested.append((i, base, [r for r in runs if not any(a < r[1] and r[0] < b for a, _, b in base)]))
    kinds = {run for _, _, runs in tested for _, _, run in runs}
    df = spark.createDataFrame([(b,) for b in kinds], "r string").select("r", secret_scan.battery(F.col("r")).alias("t"))
    found = {r.r: r.t for r in df.collect()}
    for body in (x for x in kinds if not x.isalpha()):  # letters alone have encodings of their own
        k, n, p = plain_battery(body)
        assert (found[body].encoding, found[body].n) == (k, n) and abs(found[body].p - p) <= 1e-6 + 1e-3 * p
    place = lambda b: (found[b].encoding * 64 + int(np.floor(np.log2(found[b].n))),
                       min(int(np.floor(-10 * np.log10(found[b].p))), secret_scan.LAST_BIN) if found[b].p > 0 else secret_scan.LAST_BIN)
    for body in kinds:
        bins[place(body)[0]][place(body)[1]] += 1
    limits = secret_scan.rejected_from(bins, 0.05)
    text = lambda xs: ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in xs)
    for i, base, runs in tested:
        spans = sorted([*base, *[(a, 3, b) for a, b, run in runs if place(run)[1] < limits[place(run)[0]]]])
        yield (i, *[sum(k == n for _, k, _ in base) for n in range(3)], hashlib.sha256(text(base).encode()).hexdigest(), text(spans))


def test_op2(spark, some):
    same([tuple(r) for r in queries.QUERIES["op2_secret_scan"](spark, SF).collect()], plain_scan(spark, texts_of(some)))


def test_op2_with_random_runs(spark, tmp_path):
    """The registered query over texts with random runs of every encoding, letters alone too, beside words and known shapes."""
    rng = np.random.default_rng(11)
    alphabets = [a for _, a in secret_scan.ENCODINGS + secret_scan.LETTERS]
    rows = [(k, f"é see {''.join(rng.choice(list(alphabets[k % len(alphabets)]), 20 + k % 30))}{'=' * (k % 3)} there") for k in range(60)]
    rows += [(100 + k, f"/usr/share/documents/of/number{k}/and/others internationalization{'s' * k}") for k in range(10)]
    rows += [(200, "key=abcdefabcdefabcdefabcdef01 password: Zk3vT8xLw2Rb7YpN4sHd6MqQ9 x=" + "Zk3vT8xLw2Rb7YpN4sHd6M"), (201, None), (202, "")]
    folder = f"file://{tmp_path}"
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = [tuple(r) for r in queries.QUERIES["op2_secret_scan"](spark, folder).collect()]
    same(got, plain_scan(spark, [(i, t or "") for i, t in rows]))
    assert sum("random" in r[-1] for r in got) >= 50


def test_op3(spark, some):
    check_packed(queries.QUERIES["op3_pattern_packing"](spark, SF).collect(), texts_of(some))


def test_op5(spark, some):
    """Base columns, and the verdict of the whole policy from the text alone."""
    def kept(t):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        n = len(words)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        chars, symbols, dup, repeat = plain_measures(t)[1:]
        upper = sum(1 for w in words if w.encode().isupper())
        marked = sum(1 for w in words if all(c in "#*$%&|<>!" for c in w[-2:]))
        return not (n < 50 or 100 * repeat > 50 * n or 100 * symbols > 10 * n or (dup >= 3 and 100 * dup > 30 * len(lines))
                    or chars < 2 * n or chars > 20 * n or 100 * upper > 30 * n or 100 * marked > 10 * n)
    want = []
    for i, t in texts_of(some):
        n, chars, symbols, dup, repeat = plain_measures(t)
        want.append((i, n, chars, symbols, dup, repeat, n < 50 or 100 * repeat > 50 * n, kept(t)))
    rows = queries.QUERIES["op5_quality_rules"](spark, SF).collect()
    same([tuple(r)[:8] for r in rows], want)
    # ablations: what the policy without a rule would keep in addition
    for r in quality_rules.ablations(quality_rules.ledger(some), "v1").collect():
        bit = quality_rules.mask([r.rule])
        assert r.n_only == sum(x.failed == bit for x in rows) and r.n_fail == sum(bool(x.failed & bit) for x in rows)


def test_op9(spark, some):
    texts = texts_of(some)
    prints = {i: plain_fingerprint(t) for i, t in texts}
    group = plain_groups(set(prints.values()), 3)
    least = defaultdict(list)
    for i, f in prints.items():
        least[group[f]].append(i)
    want = [(i, f"{prints[i]:016x}", min(least[group[prints[i]]])) for i, _ in texts]
    same([tuple(r) for r in queries.QUERIES["op9_simhash"](spark, SF).collect()], want)


def test_op10(spark, some):
    tool, want = Tokenizer.from_file(BYTE), []
    for i, t in texts_of(some):
        ids = tool.encode(t, add_special_tokens=False).ids
        decoded = tool.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    same([tuple(r) for r in queries.QUERIES["op10_bpe"](spark, SF).collect()], want)


# 8: the fit in plain Python ------------------------------------------------------------------------------------------
def plain_features(text):
    chars = f" {' '.join(text.lower().split())} "
    out = set()
    for n in toxicity.SIZES:
        for k in range(len(chars) - n + 1):
            h = 0
            for c in chars[k:k + n]:
                h = (h * 0x9E3779B1 + ord(c) + 1) % (1 << 32)
            h = (h ^ h >> 15) * 0x85EBCA6B % (1 << 32)
            out.add((h ^ h >> 13) * 0xC2B2AE35 % (1 << 32) >> (32 - toxicity.BITS))
    return out


def plain_scores(texts, labels, max_features, least_texts=3, rounds=200, step=0.05, decay=1e-4):
    """Scores of all texts, the classifier fitted on ``labels`` (id -> 0 or 1) with dense matrices."""
    features = {i: plain_features(t) for i, t in texts.items()}
    toxic, other = Counter(), Counter()
    for i, y in labels.items():
        (toxic if y else other).update(features[i])
    n1, n0 = sum(labels.values()), len(labels) - sum(labels.values())
    ratio = {b: np.log((toxic[b] + 1) * (n0 + 2) / ((other[b] + 1) * (n1 + 2))) for b in {*toxic, *other} if toxic[b] + other[b] >= least_texts}
    best = sorted(ratio, key=lambda b: (-abs(ratio[b]) * np.sqrt(toxic[b] + other[b]), b))[:max_features]
    place = {b: k for k, b in enumerate(best)}

    def vector(i):
        x = np.zeros(len(best))
        own = [b for b in features[i] if b in place]
        for b in own:
            x[place[b]] = ratio[b] / len(own) ** 0.25
        return x
    x, y = np.array([vector(i) for i in labels]), np.array(list(labels.values()), float)
    w = np.zeros(len(best) + 1)
    share = (y.sum() + 0.5) / (len(y) + 2)
    w[-1] = np.log(share / (1 - share))
    m = v = np.zeros_like(w)
    for t in range(1, rounds + 1):
        error = (1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) - y) / len(y)
        g = np.append(x.T @ error + decay * w[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return {i: 1 / (1 + np.exp(-(vector(i) @ w[:-1] + w[-1]))) for i in texts}


def test_toxicity_scores_are_the_plain_fit(spark, some):
    docs = some.where("length(text) < 1500").limit(60).cache()
    texts = dict(texts_of(docs))
    known = {i: int(k % 3 == 0) for k, i in enumerate(sorted(texts)) if k % 5}
    labels = spark.createDataFrame(list(known.items()), "doc_id long, toxic int")
    learned = {i: y for i, y in known.items() if zlib.crc32(str(i).encode()) % 5}
    for features in (50, 1 << 18):
        want = plain_scores(texts, learned, features)
        got = toxicity.classify(docs, labels, max_features=features).collect()
        assert {r.doc_id: r.score for r in got} == pytest.approx(want, abs=2e-3)


# the pipeline's first and last stage ----------------------------------------------------------------------------------
def test_toxic_stage(spark, some):
    import corpus_pipeline as P

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(some, labels)
    out = P.drop_toxic(spark, some, SF)
    assert out.columns == some.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, t in texts_of(some) if model.score(t) < 0.5)


def test_packing_stage(spark, some):
    import corpus_pipeline as P

    check_packed(P.pack_sequences(spark, some, SF).collect(), texts_of(some))


def test_pipeline_drops_its_tables(spark, tmp_shared):
    import corpus_pipeline as P
    from pagefeatures.session import child_names

    before = child_names(spark, f"{tmp_shared}/runs")
    rows = P.run(spark, SF)
    assert child_names(spark, f"{tmp_shared}/runs") == before
    assert rows.count() > 0  # the result stays
