"""Licence scans, Merkle manifests and ranked search against brute force and odd input."""

import math
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sightline.llm import lexical_search, licences, merkle, queries, words
from sightline.llm.tables import held_out

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, branch string, rank int, labels string"
VOCABULARY = "Sun moon, star. rain! größe Tree leaf-root 4x4 bark ÄRA seed license by cc the".split()
NOTICES = ["Licensed under CC BY-NC 4.0.", "All rights reserved.", "Released under the MIT License.", "GNU General Public License, version 3", "cc by cc by", "Licensed under the Apache License, Version 1.0.", "ALL RIGHTS\nRESERVED"]


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(VOCABULARY, n))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, prose(i, 20 + i) + " " + NOTICES[i % len(NOTICES)] * (i % 3), ["en", "de", None, "", "x"][i % 5], f"s{i % 3}" if i % 4 else None, i if i % 6 else None) for i in range(60)]
    rows += [(100, None, None, None, None), (101, "", "en", "", 0), (102, "12 34", "alone", "s0", 5), (103, prose(1, 4000) + NOTICES[3], "en", "s1", 1)]
    rows += [(None, prose(77, 30), "en", "s1", 1), (None, None, "en", None, None), (5, rows[5][1], "en", "s2", 1), (5, rows[5][1], "en", "s2", 1)]
    return spark.createDataFrame([(*r, "old", 7, "none") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.filter("false")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_words_in_pieces():
    texts = [prose(3, 500), None, "", "a" * 3000, "über-ÜBER x", prose(4, 9)]
    for limit in (16, 64, 1 << 20):
        got = defaultdict(list)
        for row, place, value in words.hashed_words(pa.array(texts), limit):
            for r, p, v in zip(row.tolist(), place.tolist(), value.tolist()):
                assert p == len(got[r])
                got[r].append(v)
        for i, text in enumerate(texts):
            assert got[i] == words.hashes_of(plain_words(text)).tolist() if text else not got[i]


def scanned(docs):
    """The scan's definition, a place at a time."""
    base, notices = licences.BASE, [licences.notice(*n) for n in licences.NOTICES]
    known = {w for n in notices for w in n.words} | {w for p, _ in base for w in p.split()}
    holding = Counter(w for d in docs for w in known & set(plain_words(d.text)))
    out = []
    for d in docs:
        own = plain_words(d.text)
        stands = lambda at, w: 0 <= at < len(own) and own[at] == w
        places = [(i, label) for p, label in base for i in range(len(own)) if own[i : i + len(p.split())] == p.split()]
        rare = sorted(known & set(own), key=lambda w: (holding[w], w))[: licences.RARE]
        found = set()
        for n in notices:
            for start in range(-len(n.words), len(own)):
                there = [stands(start + q, w) for q, w in enumerate(n.words)]
                agreeing = {w for q, w in enumerate(n.words) if there[q] and w in rare}
                share = sum(there) / len(there)
                if len(agreeing) >= licences.AGREEING and all(there[q] for q in n.needed) and share >= licences.SHARE:
                    found.add((n.label, start, start + len(n.words) - 1, share))
        labels = {x for _, x in places}
        starts = [i for i, _ in places] or [None]
        score = 1.0 if places else max([f[3] for f in found], default=0.0)
        out.append((d.doc_id, len(own), len(places), starts[0] if len(starts) == 1 else min(starts), starts[0] if len(starts) == 1 else max(starts), ",".join(sorted(labels)), ",".join(sorted(labels | {f[0] for f in found})), score, tuple(sorted(found))))
    return Counter(out)


def test_licences(odd, empty):
    rows = licences.scan(odd).collect()
    assert Counter((*r[:8], tuple(sorted(tuple(n) for n in r.notices))) for r in rows) == scanned(odd.collect())
    assert {"mit", "cc-by,cc-by-nc", "gpl,gpl-3.0", "reserved", ""} <= {r.labels for r in rows}
    assert licences.scan(empty).count() == 0 and licences.scan(odd.filter("text is null or text = ''")).filter("n_words = 0 and labels = ''").count() == 3


def folded(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha256("".join(levels[-1][i : i + 2]).encode()).hexdigest() for i in range(0, len(levels[-1]), 2)])
    return levels


def climb(levels, i, node):
    """(siblings from the leaf up, root recomputed from node)."""
    siblings = []
    for level in levels[:-1]:
        pair = [node if j == i else level[j] for j in range(i & ~1, min(len(level), (i | 1) + 1))]
        siblings += [level[i ^ 1]] if (i ^ 1) < len(level) else []
        node, i = sha256("".join(pair).encode()).hexdigest(), i >> 1
    return siblings, node


def manifest(docs):
    """The contract's columns by plain folding."""
    leaf = lambda *fields: sha256("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields).encode()).hexdigest()
    by = defaultdict(list)
    for d in docs:
        bad = d.doc_id is not None and zlib.crc32(str(d.doc_id).encode()) % 7 == 0 and d.n_chars is not None
        before, after = (leaf(d.doc_id, d.source, d.lang, n, d.text) for n in (d.n_chars, d.n_chars + 1 if bad else d.n_chars))
        by[d.lang].append((d.doc_id, before, after))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[lang] = folded([r[1] for r in by[lang]])
    top = folded([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (name, before, after) in enumerate(by[lang]):
            low, node = climb(trees[lang], i, after)
            high, node = climb(top, k, node)
            out.append((name, before, trees[lang][-1][0], top[-1][0], sha256("".join(low + high).encode()).hexdigest(), node, node == top[-1][0]))
    return Counter(out)


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_merkle(spark, odd, bits):
    rows = merkle.versions(odd, {"n_chars": F.col("n_chars") + 1}, held_out("doc_id", 7, 0), bits)
    rows = rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("path")), "folded_root", "verified", "copied", "path").collect()
    assert Counter(tuple(r[:7]) for r in rows) == manifest(odd.collect())
    assert any(not r.verified for r in rows)
    for r in rows:  # a version copies the ancestors of its leaf and nothing else
        assert len(r.copied) == (0 if r.verified else len(r.path)) and (r.verified or r.copied[-1] == r.folded_root)


def test_merkle_small(spark, odd, empty):
    one = odd.filter("doc_id = 102")
    (row,) = merkle.versions(one, {}, F.lit(False)).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.path == row.copied == []
    assert merkle.versions(empty, {}, F.lit(False)).count() == 0


def ranked(docs, items, most):
    """The ranking's definition, a document and an item at a time."""
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = lambda text: [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(term, text or "")]
    texts = [(d.doc_id, Counter(terms(d.text))) for d in docs]
    n_docs, n_words = sum(1 for _, c in texts if c), sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    out = []
    for item in items:
        scores = []
        for name, have in texts:
            score = 0
            for t in terms(item.text):
                if have[t]:
                    m = 25 + 75 * sum(have.values()) * n_docs // n_words
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * have[t] // (1000 * have[t] + 8 * m))
            if score > 0:
                scores.append((-score, name is None, name or 0, name))
        out += [(item.item_id, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:most])]
    return Counter(out)


@pytest.mark.parametrize("portion, cells", [(4 << 20, 1 << 21), (100, 50)])
def test_search(spark, odd, portion, cells, monkeypatch):
    monkeypatch.setattr(lexical_search, "PORTION", portion)
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    items = [(i, prose(500 + i, 1 + i)) for i in range(12)] + [(20, None), (21, ""), (22, "nowhere else"), (None, "star Star STAR"), (3, "4x4"), (3, "4x4")]
    items = spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, rank int, score string")
    for most in (1, 10):
        got = lexical_search.search(odd, items, most).collect()
        assert Counter(map(tuple, got)) == ranked(odd.collect(), items.collect(), most)


def test_search_empty(spark, odd, empty):
    items = spark.createDataFrame([(1, "sun")], "item_id long, text string")
    for docs, wanted in ((empty, items), (odd, items.filter("false")), (odd.filter("text = ''"), items)):
        got = lexical_search.search(docs, wanted)
        assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_scores_beyond_doubles():
    index = lexical_search.inverted(["a a b", "b"])
    row, term, worth = np.array([0, 0, 1]), np.array([0, 1, 1]), np.array([2**61, 3, 5])
    for weights in (np.array([1, 1]), np.array([2**40, 2**40])):
        exact = lexical_search._scores(index, weights, row, term, worth, 2)
        assert exact[:, 1].tolist() == [3, 5]
    assert exact[:, 0].tolist() == [2**62 + 3, 5]


def test_whole_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    assert Counter(map(tuple, queries.op12_merkle(spark, folder).collect())) == manifest(docs)
    assert Counter(map(tuple, queries.op13_lexical_search(spark, folder).collect())) == ranked(docs, items, 10)
    assert Counter(map(tuple, queries.op11_licences(spark, folder).collect())) == Counter({k[:8]: v for k, v in scanned(docs).items()})
