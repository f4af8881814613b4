"""The training-data operators against brute force, round trips and odd input."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sightline.llm import fingerprints, graph, languages, mixing, near_dups, packing, pii, token_files, tokens, toxicity, url_rules, vectors

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "sun moon star rain wind tree leaf root bark seed rock sand wave tide foam shell bird nest wing song".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n)) + "."


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, prose(i, 40 + i), "en" if i % 2 else "xx", f"s{i % 3}", 0) for i in range(30)]
    rows += [(100, None, None, None, None), (101, "", "en", "", 0), (102, "12 34", "en", "s0", 5), (103, prose(1, 20_000), "en", "s1", 1)]
    rows += [(None, prose(77, 30), "en", "s1", 1), (5, rows[5][1], "en", "s2", 1), (5, rows[5][1], "en", "s2", 1)]
    return frame(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def test_pseudonyms(spark):
    text = "Mail ann.lee7@mail3.example.com or +1 (713) 555-8702, card 4041894974608795, host 42.144.35.254, born 1984-03-07, 31.12.1999; SSN 219-09-9999; IBAN GB82 WEST 1234 5698 7654 32."
    kept = "card 4041894974608796, host 300.1.2.3, version 1.2.3, 2023-02-31, 12:30, 555 apples"
    df = pii.pseudonymise(frame(spark, [(1, text, "a", None, 0), (2, text + " x", None, None, 0), (3, kept, None, None, 0), (4, None, None, None, 0), (5, "", None, None, 0)]), "k")
    got = {r.doc_id: r.text for r in df.collect()}
    assert got[2] == got[1] + " x" and got[3] == kept and got[4] is None and got[5] == ""
    shape = lambda t: "".join("9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c for c in t)
    no_host = lambda t: t[: t.index("host")] + t[t.index(", born") :]
    assert shape(no_host(got[1])) == shape(no_host(text)) and got[1] != text
    for value in ("ann.lee7", "713) 555-8702", "4041894974608795", "42.144.35.254", "1984-03-07", "31.12.1999", "219-09-9999", "WEST 1234"):
        assert value not in got[1]
    card = got[1].split("card ")[1][:16]
    assert sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(card[::-1])) % 10 == 0
    iban = got[1].split("IBAN ")[1].rstrip(".").replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert pii.pseudonymise(frame(spark, [(1, text, None, None, 0)]), "other").first().text != got[1]


def test_ibans_before_upper_case_words_and_numbers(spark):
    own = ["ES91 2100 0418 4502 0005 1332", "LU28 0019 4006 4475 0000", "BE68 5390 0754 7034", "BE68539007547034", "GB82 WEST 1234 5698 7654 32", "DE89 3704 0044 0532 0130 00"]
    ends = ["", ".", " BIC", " EUR 12", " SWIFT", " 1234", " 2024 ", " 4041894974608795", " GB82 WEST 1234 5698 7654 32"]
    pairs = [(iban, end) for iban in own for end in ends]
    df = pii.pseudonymise(frame(spark, [(i, f"to {iban}{end}", None, None, 0) for i, (iban, end) in enumerate(pairs)]), "k")
    got = {r.doc_id: r.text for r in df.collect()}
    for i, (iban, end) in enumerate(pairs):
        new = got[i][3 : 3 + len(iban)]
        plain = new.replace(" ", "")
        assert new != iban and new == got[own.index(iban) * len(ends)][3:], (iban, end, got[i])
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
        if "4041" in end or "WEST" in end:
            assert end not in got[i]
        else:
            assert got[i] == f"to {new}{end}"


def test_numeric_permutation_is_one_to_one(spark):
    pairs = spark.range(11 * 13).select(pii.permuted("k", "t", F.col("id") % 11, F.floor(F.col("id") / 11), 11, 13).alias("p")).select("p.*")
    got = pairs.collect()
    assert len({(r.l, r.r) for r in got}) == 143 and all(0 <= r.l < 11 and 0 <= r.r < 13 for r in got)


def test_fingerprints(spark, odd, empty):
    a, b = prose(1, 2000), prose(2, 2000)
    x, y, z, n = fingerprints.digests(pa.array([a, a[:500] + "inserted words " + a[500:], b, None]))
    assert fingerprints.contained(x, y) > 0.9 and fingerprints.contained(x, z) < 0.1 and len(n) == 0 and fingerprints.contained(n, n) == 1
    ends = fingerprints.chunk_ends(np.frombuffer(a.encode(), np.uint8), np.array([0, len(a)]))[1]
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(a) and sizes[:-1].min() >= 32 and sizes.max() <= 256
    got = fingerprints.edited_neighbours(odd).collect()
    rows = sorted([(r.doc_id if r.doc_id is not None else -1, r.text or "") for r in odd.collect()], reverse=True)
    want = Counter()
    for i, (name, text) in enumerate(rows):
        after, third = rows[(i + 1) % len(rows)][1], len(text) // 3
        want[name, len(text), hashlib.sha256((text[: len(text) - third] + after[:third]).encode()).hexdigest()] += 1
    assert Counter((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert fingerprints.edited_neighbours(empty).count() == 0
    assert fingerprints.fingerprints(odd.withColumn("fingerprint", F.lit("old"))).filter("text = ''").first().fingerprint == ""


def test_url_rules(spark):
    urls = ["http://a.example.net/en/1?x", "https://Example.NET/fr", "http://example.com/de/", "http://notexample.com/de/", "http://x.org/fr/a#b", "http://x.org/en", "http://net", "http://net/", "mailto:x", None, "", "http://sub-net.io/", "http://a.example.net/en/1?x"]
    rows = frame(spark, [(i, u, "rule!") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(rows, url_rules.rule_table(spark)).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        rest = (url or "").partition("://")[2].split("?")[0].split("#")[0]
        host, slash, path = rest.partition("/")
        host, path = "".join(c.lower() if c.isascii() else c for c in host), slash + path
        fits = [(len(h + p), h + p, v) for h, p, v in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[i] == (host, path, *(max(fits)[1:] if fits else (None, "allow"))), url
    assert url_rules.judge(rows, url_rules.rule_table(spark).filter("false")).filter("verdict <> 'allow'").count() == 0
    assert url_rules.judge(rows.filter("false"), url_rules.rule_table(spark)).count() == 0


def test_mixing(spark, odd, empty):
    rows = mixing.draw_plan(odd).collect()
    again = mixing.draw_plan(odd).collect()
    assert Counter((r.doc_id, r.size, len(r.places)) for r in rows) == Counter((r.doc_id, r.size, len(r.places)) for r in again)
    assert len(rows) == odd.count() and all(len(r.places) <= 3 for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    total, names = sum(r.size for r in rows), sorted(by, key=lambda s: (s is None, s or ""))
    size, weight = {s: sum(r.size for r in by[s]) for s in names}, {s: 1.0 + i % 3 for i, s in enumerate(names)}
    target, still = {}, set(names)
    while still:
        level = (total - sum(target.values())) / sum(weight[s] for s in still)
        over = {s for s in still if level * weight[s] > 3 * size[s]} or still
        target |= {s: min(3 * size[s], level * weight[s]) for s in over}
        still -= over
    for s in names:
        assert abs(by[s][0].target - target[s]) < 1e-6 and by[s][0].source_size == size[s]
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(len(r.places) for r in rows)
    assert mixing.draw_plan(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mixing_comes_near_targets(spark):
    rows = frame(spark, [(i, prose(i, 5 + i % 90), None, "abcd"[min(3, i % 7)], 0) for i in range(1500)])
    got = mixing.draw_plan(rows).groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("size") * F.size("places")).alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 0.002 * r.target + 5 for r in got)


def test_mixing_fills_behind_a_very_long_document(spark):
    texts = [(f"{s}{n}", prose(n, 5 + n % 60) if n else prose(n, 4500)) for s in "abcdefgh" for n in range(300)]
    rows = frame(spark, [(i, text, None, name[0], 0) for i, (name, text) in enumerate(texts)])
    for seed in (7, 8):
        plan = mixing.draw_plan(rows, levels=2, seed=seed).collect()
        for own in _grouped(plan, lambda r: r.source).values():
            taken = sum(r.size * len(r.places) for r in own)
            assert abs(taken - own[0].target) <= 3, (seed, own[0].source, taken, own[0].target)
        assert all(0 <= p["shard"] < 4 for r in plan for p in r.places)
        assert all(len({p["copy"] for p in r.places}) == len(r.places) for r in plan)


def test_shards_get_equal_numbers_of_blocks(spark):
    quotas = spark.createDataFrame([("=a", 100), ("=b", 37), ("", 0), ("=c", 7)], "source_key string, quota long")
    got = mixing._split_quotas(quotas, 3, 1).collect()
    assert set(Counter(r.shard for r in got for _ in range(r.taken)).values()) == {18}
    assert Counter(r.source_key for r in got for _ in range(r.taken)) == {"=a": 100, "=b": 37, "=c": 7}


def test_token_blocks_round_trip():
    rng = np.random.default_rng(0)
    for docs in ([], [np.zeros(0, np.uint32)], [np.array([7], np.uint32)], [rng.integers(0, 50_000, n).astype(np.uint32) for n in (3, 0, 5000)], [np.array([1, 2**32 - 1] * 400, np.uint32)], [rng.zipf(1.3, 20_000).clip(0, 30_000).astype(np.uint32)]):
        back = token_files.read_block(token_files.write_block(docs))
        assert len(back) == len(docs) and all((a == b).all() and len(a) == len(b) for a, b in zip(docs, back))
    block = bytearray(token_files.write_block([np.arange(500, dtype=np.uint32)]))
    block[-200] ^= 1
    with pytest.raises(ValueError):
        token_files.read_block(bytes(block))
    text = np.tile(rng.integers(0, 300, 400), 20).astype(np.uint32)
    assert len(token_files.write_block([text])) < 2 * len(text)


def test_blocks_hold_any_number_of_distinct_ids():
    rng = np.random.default_rng(5)
    for documents in ([rng.integers(0, 50_257, n) for n in (0, 1, 90_000, 5)], [np.arange(70_000) * 7, np.full(1000, 3)]):
        back = token_files.read_block(token_files.write_block(documents))
        assert [x.tolist() for x in back] == [x.tolist() for x in documents]


def test_a_column_is_encoded_by_its_distinct_words():
    coder = tokens.Encoder(tokens.vocabulary_path())
    odd = ["", " ", "a", " a", "a ", "a  b", "a b  c ", "\n", "a\n b", "a\tb c", "<|endoftext|>", "x <|endoftext|> y", "don't 's  t", None, "a\u00a0b", "\u3000x y", "é è"]
    odd += [f"{x or ''} {y or ''}" for x in odd for y in odd]
    ids, ends = coder.encode_all(pa.array(odd))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [coder.tokenizer.encode(x or "", add_special_tokens=False).ids for x in odd]
    assert len(coder.encode_all(pa.array([], pa.string()))[0]) == 0

    class Counted:
        calls, real = 0, coder.tokenizer

        def encode_batch_fast(self, texts, **how):
            self.calls += 1
            return self.real.encode_batch_fast(texts, **how)

    coder.later.tokenizer = coder.first.tokenizer = counted = Counted()
    coder.encode_all(pa.array([f"word{i} word{i + 1} other" for i in range(1000)]))
    assert counted.calls <= 3  # before: a call for each text


def test_ranks_and_shares_of_a_block():
    rng = np.random.default_rng(3)
    for ids in (np.zeros(0, np.int64), rng.integers(0, 500, 3000), rng.integers(0, 1 << 32, 3000)):
        assert all((x == y).all() for x, y in zip(token_files._ranked(ids), np.unique(ids, return_inverse=True)))
    model = token_files.Model(300)
    model.counts += rng.integers(0, 50, 300)
    model._refresh()
    free = rng.integers(0, int(model.top), token_files.LANES).astype(np.uint64)
    free[:2] = 0, int(model.top) - 1
    assert (model.holding(free) == np.searchsorted(model.until, free, "right") - 1).all()


def test_token_files_and_packing(spark, odd, empty, tmp_path):
    plain = tokens.Encoder(tokens.vocabulary_path()).tokenizer
    ids = lambda t: plain.encode(t or "", add_special_tokens=False).ids
    spaced = ["  a  b", "a\n b", " a", "a ", "don't  stop\n\n now", "<|endoftext|> x", "é ü 12 3", "a  b", " "]
    assert [np.frombuffer(tokens.encoder(tokens.vocabulary_path()).encode(t), "<u4").tolist() for t in spaced] == [ids(t) for t in spaced]
    token_files.write_token_files(odd, str(tmp_path / "t"))
    read, starts = token_files.read_token_files(spark, str(tmp_path / "t")), token_files.token_offsets(spark, str(tmp_path / "t"))
    got = sorted((r.start, -1 if r.doc_id is None else r.doc_id, bytes(r.ids)) for r in read.join(starts, ["shard", "block", "nth"]).collect())
    at = 0
    for (start, _, data), (_, text) in zip(got, sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in odd.collect()), strict=True):
        assert start == at and np.frombuffer(data, "<u4").tolist() == [*ids(text), 2]
        at += len(data) // 4
    pieces, docs = packing.pack(odd).collect(), Counter()
    for name, own in _grouped(pieces, lambda r: r.sequence_id).items():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1]) and sum(r.length for r in own) <= 1024
    for r in pieces:
        docs[r.doc_id] += r.length
        assert r.length * 4 == len(r.ids)
    assert docs == Counter({k: sum(len(ids(t)) + 1 for t in v) for k, v in _grouped([(r.doc_id, r.text) for r in odd.collect()], lambda r: r[0], lambda r: r[1]).items()})
    assert packing.pack(empty).count() == 0


def _grouped(rows, key, value=lambda r: r):
    out = defaultdict(list)
    for r in rows:
        out[key(r)].append(value(r))
    return out


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 101, 300).tolist()
    room = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in room if r >= n]
        if fit:
            room[room.index(min(fit))] -= n
        else:
            room.append(100 - n)
    places = packing.best_fit_decreasing(lengths, 100)
    used = Counter()
    for (name, _), n in zip(places, lengths):
        used[name] += n
    assert sorted(100 - u for u in used.values()) == sorted(room)


def test_near_duplicates(spark, odd, empty):
    base = prose(9, 300).split()
    rows = [(1000 + i, " ".join(base[:i] + ["zz"] + base[i:]), "en", "s", 0) for i in range(0, 300, 30)]
    rows += [(2000 + i, " ".join(base[: 5 * i] + prose(50 + i, 300).split()[5 * i :]), "en", "s", 0) for i in range(0, 60, 7)]
    both = odd.unionByName(frame(spark, rows))
    got = near_dups.near_duplicates(both).collect()
    texts = [(r.doc_id, r.text or "") for r in both.collect()]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} if t.split() else set() for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i][1] == texts[j][1] or sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(texts):
        if name is not None:
            least[find(i)] = min(least.get(find(i), name), name)
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter((name, least.get(find(i))) for i, (name, _) in enumerate(texts))
    kept = near_dups.drop_near_duplicates(both)
    assert kept.columns == both.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(least.values()))
    assert near_dups.near_duplicates(empty).count() == 0 and near_dups.drop_near_duplicates(empty).count() == 0


def test_classes_that_share_an_id_all_stay(spark):
    a, b, c = (prose(n, 60) for n in (201, 202, 203))
    rows = [(1, a, "en", "s", 0), (1, b, "en", "s", 0), (1, b, "en", "s", 0), (2, b, "en", "s", 0), (3, c, "en", "s", 0)]
    got = near_dups.drop_near_duplicates(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(1, a), (1, b), (3, c)])


def test_blocks_join_what_stars_leave_apart(spark):
    chain = [[int(x) for x in range(i * 5, i * 5 + 100)] for i in range(8)]
    import pandas as pd

    group = pd.DataFrame({"digest": [bytes([i]) for i in range(8)], "class": [bytes([i]) for i in range(8)], "side": 2, "elements": [np.array(c) for c in chain]})
    links = near_dups._joining_links(group, 0.8)
    assert len(links) == 7


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    names = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    a, b = rng.uniform(0.2, 5, 60), rng.uniform(0.2, 5, 60)
    row = np.repeat([0, 1], 60)
    value, full = near_dups.signatures(row, np.tile(names, 2), np.concatenate([a, b]), 2)
    assert full.all() and abs((value[0] == value[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.12


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (200, 200), (None, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 200: 200}


def test_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    rows = np.concatenate([base, base[:20] + 0.1 * rng.normal(size=(20, 16)), 3 * base[:5], base[:1], base[:1]])
    data = [(i, v.tolist()) for i, v in enumerate(rows)]
    data += [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15), (904, [1.0, 2.0]), (905, [1.0, 2.1])]
    got = {r.vec_id: r for r in vectors.link_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()}
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    assert [got[i].n_links for i in range(len(rows))] == (near.sum(1) - 1).tolist()
    reach = np.linalg.matrix_power(near.astype(float), 16) > 0
    assert [got[i].component_id for i in range(len(rows))] == reach.argmax(1).tolist()
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (900, 901, 902, 903)) and got[904].n_links == 1
    assert vectors.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_vector_links_in_few_effective_dimensions(spark):
    for n in (2000, 6000):
        rng = np.random.default_rng(n)
        base = rng.normal(size=(n, 8)) @ rng.normal(size=(8, 64)) + 0.3 * rng.normal(size=(n, 64))
        unit = base / np.linalg.norm(base, axis=1, keepdims=True)
        cosines = unit @ unit.T
        got = vectors.link_vectors(spark.createDataFrame(pd.DataFrame({"vec_id": range(n), "embedding": list(base)}), "vec_id long, embedding array<double>"))
        found = {r.vec_id: r.n_links for r in got.collect()}
        assert ((cosines >= 0.9) & (cosines < 0.96)).sum() > 1000
        assert [found[i] for i in range(n)] == ((cosines >= 0.9).sum(1) - 1).tolist()


def test_code_lengths_are_exact():
    trees = languages.grow({"a": [b"abracadabra abracadabra"], "b": [b"banana bandana"]}, least=1)
    counts = {"a": defaultdict(Counter), "b": defaultdict(Counter)}
    for name, data in (("a", b"abracadabra abracadabra"), ("b", b"banana bandana")):
        padded = [None] * 3 + list(data)
        for i in range(3, len(padded)):
            for order in range(4):
                counts[name][tuple(padded[i - order : i])][padded[i]] += 1

    def bits(name, context, symbol):
        seen = counts[name].get(context)
        if not seen:
            return bits(name, context[1:], symbol) if context else 8.0
        total = sum(seen.values()) + len(seen)
        if symbol in seen:
            return -np.log2(seen[symbol] / total)
        return -np.log2(len(seen) / total) + (bits(name, context[1:], symbol) if context else 8.0)

    ascii_want = [sum(bits(n, tuple(([None] * 3 + list(b"aban abra"))[i - 3 : i]), ([None] * 3 + list(b"aban abra"))[i]) for i in range(3, 12)) for n in ("a", "b")]
    assert np.allclose(languages.code_lengths(trees, pa.array(["", "aban abra", None]))[1], ascii_want, rtol=1e-4)


def test_languages(spark, odd, empty):
    rows = [(i, prose(i, 30) if i % 2 else prose(i, 30)[::-1], "en" if i % 2 else "ne", "s", 0) for i in range(120)]
    trees = languages.fit(frame(spark, rows), F.col("doc_id") < 80)
    got = {r.doc_id: r for r in languages.identify(frame(spark, rows).withColumn("lang_pred", F.lit("zz")), trees).collect()}
    assert all(got[i].lang_pred == rows[i][2] and 0.5 < got[i].lang_score <= 1 for i in range(80, 120))
    found = {r.doc_id: r for r in languages.identify(odd, trees).collect()}
    assert all(found[i].lang_pred == "und" and found[i].lang_score == 0 for i in (100, 101, 102))
    none = languages.fit(empty, F.lit(True))
    assert {r.lang_pred for r in languages.identify(odd, none).collect()} == {"und"} and languages.identify(empty, trees).count() == 0


def test_toxicity(spark, odd, empty):
    rows = [(i, prose(i, 40) + (" vile" + WORDS[i % 20] + " filth" if i % 3 == 0 else ""), "en", "s", 0) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(1, None), (None, 1)], "doc_id long, toxic int")
    network, trees = toxicity.fit(frame(spark, rows), labels, lambda name: F.col(name).isNotNull())
    got = {r.doc_id: r.toxicity for r in toxicity.score(frame(spark, rows), network, trees).collect()}
    right = [(got[i] >= toxicity.CUT) == (i % 3 == 0) for i in range(300, 400)]
    assert np.mean(right) > 0.95 and all(0 <= v <= 1 for v in got.values())
    assert toxicity.score(odd, network, trees).filter("toxicity is null").count() == 0
    network, trees = toxicity.fit(empty, labels.filter("false"), lambda name: F.col(name).isNotNull())
    assert {round(r.toxicity, 9) for r in toxicity.score(odd, network, trees).collect()} == {toxicity.CUT}


def test_toxicity_learns_from_every_row(spark):
    insults = [f"{a}q{b}x{a}" for a in "bdfgkm" for b in "aeio"]  # most are too rare in the sample to be learnt from it
    rows = [(i, prose(i, 40) + (f" {insults[i // 3 % len(insults)]} " if i % 3 == 0 else " ") + prose(i + 5000, 5), "en", "s", 0) for i in range(1500)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(1200)], "doc_id long, toxic int")
    scores = []
    for docs in (frame(spark, rows), frame(spark, rows[::-1]).repartition(5)):
        network, trees = toxicity.fit(docs, labels, lambda name: F.col(name).isNotNull(), per_class=60)
        scores.append({r.doc_id: r.toxicity for r in toxicity.score(docs, network, trees).collect()})
    assert np.mean([(scores[0][i] >= toxicity.CUT) == (i % 3 == 0) for i in range(1200, 1500)]) > 0.95
    assert scores[0].keys() == scores[1].keys() and all(abs(v - scores[1][i]) < 1e-6 for i, v in scores[0].items())  # whatever the partitions and their order
    z, y, n = np.array([0.0, 1, 2, 3]), np.array([0.0, 1, 0, 1]), np.array([3, 1, 2, 5])
    assert toxicity.best_threshold(z, y, n) == toxicity.best_threshold(np.repeat(z, n), np.repeat(y, n)) == 2.5


def test_pipeline_stages(spark, odd):
    import corpus_pipeline as cp

    docs, seen = odd, {}
    for name, stage in cp.STAGES:
        done = stage(spark, docs, "")
        docs = spark.createDataFrame(done.collect(), done.schema)
        seen[name] = docs
    assert {r.doc_id for r in odd.collect()} - {r.doc_id for r in seen["language"].collect()} == {100, 101, 102}
    assert [f.columns for f in list(seen.values())[:4]] == [odd.columns] * 4
    assert seen["near_dedup"].filter("doc_id = 5").count() == 1
    lengths = Counter(r.doc_id for r in seen["mixing"].collect())
    pieces = _grouped(seen["packing"].collect(), lambda r: r.doc_id)
    assert set(lengths) == set(pieces)


def test_probe_share_follows_the_directions_of_partners(spark):
    for seed, size, low, high in ((1, 3000, 0.2, 0.7), (2, 6000, 0.2, 0.7)):
        rng = np.random.default_rng(seed)
        base = rng.normal(size=(size, 64))
        base[size // 2 :] = base[: size // 2] + 0.42 * rng.normal(size=(size // 2, 64))  # cosines around 0.92
        rows = spark.createDataFrame(pd.DataFrame({"vec_id": range(size), "embedding": list(base)}), "vec_id long, embedding array<double>")
        unit = base / np.linalg.norm(base, axis=1, keepdims=True)
        near = unit @ unit.T >= 0.9
        got = {r.vec_id: r.n_links for r in vectors.link_vectors(rows, loss=vectors.LOSS).collect()}
        found, want = np.array([got[i] for i in range(size)]), near.sum(1) - 1
        assert want.sum() > 2000 and (found <= want).all() and found.sum() >= 0.98 * want.sum()
        index = vectors.build_index(unit[:2000], size // 256)
        keyed = spark.createDataFrame(pd.DataFrame({"key": [i.to_bytes(4) for i in range(size)], "v": list(base)}), "key binary, v array<double>")
        names = np.array([i.to_bytes(4) for i in range(2000)], object)
        assert low < vectors.probe_share(keyed, index, names, unit[:2000], 0.9, 0.01) < high


def test_least_share():
    assert vectors.least_share([], 0, 0.01) == 1 and vectors.least_share([(3, 100.0)], 100, 0.01) == 1
    assert vectors.least_share([(3, 990.0), (40, 10.0)], 1000, 0.01) == 0.41 and vectors.least_share([(3, 995.0), (40, 5.0)], 1000, 0.01) == 0.04


def test_columns_with_clashing_names(spark):
    names = ["active_host", "active_rules", "best_rule", "_Active_Host"]
    pages = spark.createDataFrame([(1, "http://net/a", *names), (2, None, *names)], ["page_id", "url", *names])
    got = url_rules.judge(pages, url_rules.rule_table(spark)).collect()
    assert [tuple(r[n] for n in names) for r in got] == [tuple(names)] * 2 and {r.page_id: r.rule for r in got} == {1: "net/", 2: None}
    names = ["kept_id", "kept_digest", "own_id", "own_key", "own_digest", "mix_id", "mix_key", "mix_turn", "mix_place", "mix_places", "mix_rows", "row", "a.b", "label", "place", "near_own_digest", "label_id"]
    rows = [(i, prose(i // 2, 30), None, "s", 0, *[f"{n}{i}" for n in names]) for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", `{n}` string" for n in names))
    kept = near_dups.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} == set(rows[::2])
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {tuple(r) for r in mixed.collect()} == set(rows)
    labels = spark.createDataFrame([(i, i % 4 // 2) for i in range(20)] + [(0, 0), (1, 1), (2, None)], "doc_id long, toxic int")
    docs = docs.drop("a.b")
    net, trees = toxicity.fit(docs, labels, lambda c: F.lit(True))
    scored = toxicity.score(docs, net, trees)
    assert scored.columns == [*docs.columns, "toxicity"] and scored.filter("toxicity between 0 and 1").count() == 20
