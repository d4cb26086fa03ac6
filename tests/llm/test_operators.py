"""Each operator against a plain version: nulls, empty and long texts, copies, ties, clashing columns."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import decontaminate, factors, jaccard, pii, quality, sha, shingles, substrings
from tokenizers import Tokenizer

from rowsluice.llm import common
from rowsluice.llm.common import tokenizer_path
from rowsluice.llm.decontaminate import Decontaminator
from rowsluice.llm.jaccard import JaccardJoin, RTree, may_link, point
from rowsluice.llm.licenses import LicenseScanner
from rowsluice.llm.packing import Packer, fullest, minimum_slack
from rowsluice.llm.pii import ContextExtractor, listed
from rowsluice.llm.quality import LineFrequency
from rowsluice.llm.simple8b import TokenFiles, pack, unpack
from rowsluice.llm.suffix_arrays import FactorDedup
from rowsluice.llm.suffix_trees import SubstringDedup
from rowsluice.llm.tokens import Encoder
from rowsluice.llm.toxicity import Ftrl, ToxicityModel, held_out

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, tag string, id int, n string, row int, words string, spans string"


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    words = [f"w{r.randrange(vocabulary)}é"[: r.randint(2, 5)] + r.choice(["", ",", "."]) for _ in range(n)]
    return "".join(w + ("\n" if r.random() < 0.05 else " ") for w in words)


def edited(text, seed, share):
    r = random.Random(seed)
    words = text.split(" ")
    return " ".join("edit" + str(r.random()) if r.random() < share else w for w in words)


def corpus():
    base, passage = prose(1, 300), prose(2, 60)
    rows = [(10, base), (11, base), (12, edited(base, 3, 0.01)), (13, edited(base, 4, 0.03)), (14, edited(base, 5, 0.06))]
    rows += [(20 + i, prose(30 + i, 80) + passage + prose(60 + i, 80)) for i in range(6)]
    rows += [(40 + i, edited(prose(7, 200), 100 + i, 0.004 * i)) for i in range(24)]
    rows += [(70, None), (71, ""), (72, " \n\t "), (73, "one two"), (74, "ONE  two"), (75, "tie tie tie " * 40)]
    rows += [(80, prose(8, 9000, 3000)), (81, "x" * 5000), (82, "a b " * 3000)]
    rows += [(90, prose(9, 70)), (90, prose(9, 70)), (91, prose(10, 70)), (91, prose(11, 70)), (None, base), (None, prose(12, 40))]
    rows += [(95, "mail a.b@c.de, x@@y.zz; 10.0.0.256 10.2.3.4.5.6.7.8 call +1 (389) 555-5010 or 4111 1111-1111 1111 é@b.co")]
    rows += [(96, base.upper()), (97, "漢字 " * 30 + passage)]
    random.Random(0).shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows, source="src"):
    full = [(i, t, "en", source, None, "k", "t", 1, "n", 2, "w", "s") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def same(got, want, *columns):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=key) == sorted(want, key=key)


def test_pii_base(spark, rows):
    got = ContextExtractor().extracted(frame(spark, rows)).select("doc_id", listed("base").alias("base"))
    same(got, [(i, pii(t)[1]) for i, t in rows], "doc_id", "base")


def test_pii_contexts_find_unseen_identifiers(spark):
    known = [(i, f"{prose(i, 20)}please write to user{i}@mail.example.com today {prose(i + 50, 20)}") for i in range(12)]
    hidden = [(100, f"{prose(99, 20)}please write to someone(at)mail.example today {prose(98, 20)}")]
    other = [(200, f"{prose(97, 20)}they like to write letters today {prose(96, 20)}")]
    got = ContextExtractor().extracted(frame(spark, known + hidden + other))
    spans = {r["doc_id"]: r["spans"] for r in got.select("doc_id", listed("spans").alias("spans")).collect()}
    at = hidden[0][1].index("someone(at)")
    assert spans[100] == f"email:{at}:{at + len('someone(at)mail.example')}"
    assert spans[200] == "" and all(spans[i].count("email") == 1 for i in range(12))
    text = {r["doc_id"]: r["text"] for r in ContextExtractor().redacted(frame(spark, known + hidden)).collect()}
    assert "please write to [email] today" in text[100] and "@" not in "".join(text.values())


def test_pii_takes_whole_identifiers(spark):
    known = [(i, f"{prose(i, 20)}please call me +1 389 555 {5000 + i} today {prose(i + 50, 20)}") for i in range(12)]
    hidden = [(100, "then please call me 00 33 1 23 45 67 89 today"), (101, "so call me 0033 123 456 789"), (102, "x call me " + "12 " * 5000 + "today")]
    docs = frame(spark, known + hidden)
    text = {r["doc_id"]: r["text"] for r in ContextExtractor().redacted(docs).collect()}
    assert text[100] == "then please call me [phone] today" and text[101] == "so call me [phone]"
    assert text[102] == hidden[2][1]  # no identifier has so many digits


def test_decontaminate(spark, rows):
    items = [("b1", prose(2, 60)), ("b2", "tie TIE"), ("b10", prose(500, 40)), ("b3", None), ("b4", ""), ("b2", "漢字")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    want = decontaminate(rows, items)
    for block in (500_000, 20):
        got = Decontaminator(block=block).judged(frame(spark, rows), benchmark)
        got = got.selectExpr("doc_id", "n_words", "n_hit", "size(items) AS n_items", "sha2(array_join(items, ','), 256) AS s", "contaminated")
        same(got, want, "doc_id", "n_words", "n_hit", "n_items", "s", "contaminated")
    kept = Decontaminator().clean(frame(spark, rows), benchmark)
    assert sorted(str(r[0]) for r in kept.select("doc_id").collect()) == sorted(str(w[0]) for w in want if not w[-1])
    assert kept.columns == frame(spark, rows).columns


def test_substrings(spark, rows):
    got = SubstringDedup().digested(frame(spark, rows))
    same(got, substrings(rows), "doc_id", "n_words", "n_removed", "kept_sha256")


def test_longer_prefixes_give_the_same(spark, rows, monkeypatch):
    from rowsluice.llm import suffix_arrays, suffix_trees
    from rowsluice.llm.anchors import longer_prefixes

    few = lambda *a, **k: longer_prefixes(*a, **k | {"most": 2, "least": 1})
    monkeypatch.setattr(suffix_trees, "longer_prefixes", few)
    monkeypatch.setattr(suffix_arrays, "longer_prefixes", few)
    same(SubstringDedup().digested(frame(spark, rows)), substrings(rows), "doc_id", "n_words", "n_removed", "kept_sha256")
    same(FactorDedup(keep_first=False).digested(frame(spark, rows)), factors(rows), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_factors(spark, rows):
    got = FactorDedup(keep_first=False).digested(frame(spark, rows))
    same(got, factors(rows), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    unique = [r for r in rows if r[0] not in (90, 91, None)]
    got = FactorDedup().digested(frame(spark, unique))
    same(got, factors(unique, keep_first=True), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("tile", [2000, 5])
def test_jaccard(spark, rows, tile, monkeypatch):
    from rowsluice.llm import jaccard as module

    monkeypatch.setattr(module, "TILE", tile)
    same(JaccardJoin().joined(frame(spark, rows)), jaccard(rows), "doc_id", "n_shingles", "component_id")
    kept = JaccardJoin().representatives(frame(spark, rows)).select("doc_id").collect()
    assert {r[0] for r in kept} == {i for i, _, root in jaccard(rows) if i == root}


@pytest.mark.parametrize("tile", [2000, 5])
def test_jaccard_pairs_are_complete(spark, rows, tile, monkeypatch):
    from rowsluice.llm import jaccard as module

    monkeypatch.setattr(module, "TILE", tile)
    near = [(1000 + i, edited(prose(70, 300), 300 + i, 0.004)) for i in range(40)]  # one group of more than LEAF classes
    plain = [r for r in rows if r[0] not in (90, 91, None)] + near + [(2000, near[3][1])]
    sets = [(i, shingles(t)) for i, t in plain]
    links = [(x, y) for a, (x, s) in enumerate(sets) for y, t in sets[:a]
             if s and t and 100 * len(s & t) >= 75 * len(s | t)]
    least = {}
    for i, s in sets:
        least[frozenset(s)] = min(i, least.get(frozenset(s), i))
    rep = {i: least[frozenset(s)] for i, s in sets}
    docs = frame(spark, plain)
    got = [(r["a"], r["b"]) for r in JaccardJoin().pairs(docs).collect()]
    want = {(min(rep[x], rep[y]), max(rep[x], rep[y])) for x, y in links if rep[x] != rep[y]}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 200
    n = Counter(i for pair in links for i in pair)
    found = {r["doc_id"]: (r["representative"], r["n_links"]) for r in JaccardJoin().members(docs).collect()}
    assert found == {i: (rep[i] if s else None, n[i]) for i, s in sets}


def test_tree_drops_no_link():
    r = np.random.default_rng(5)
    sets = [r.integers(0, 1 << 63, 200, dtype=np.uint64) for _ in range(40)]
    sets += [np.concatenate((sets[i][: 200 - i], r.integers(0, 1 << 63, i, dtype=np.uint64))) for i in range(40)]
    tree = RTree(np.array([200] * 80), [point(s) for s in sets])
    dropped = 0
    for x in range(80):
        near = set(tree.order[tree.candidates(x, 75)].tolist())
        own = tree.order[x]
        for y in range(80):
            common = len(np.intersect1d(sets[own], sets[y]))
            assert not may_link(common, 200, 200, 75) or y in near
        dropped += 80 - len(near)
    assert dropped > 80 * 60


def packed_ids(rows):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    return [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing(spark, rows):
    got = Packer(tokenizer_path()).packed(frame(spark, rows)).toPandas()
    want = []
    for i, ids in packed_ids(rows):
        cut = len(ids) % 1024 or 1024
        starts = [0, *range(cut, len(ids), 1024)]
        want += [(i, p, s, len(ids[s:e]), crc(ids[s:e])) for p, (s, e) in enumerate(zip(starts, [*starts[1:], len(ids)]))]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    key = lambda r: tuple(str(x) for x in r)
    plain = [tuple(None if x != x else int(x) for x in r) for r in got[columns].itertuples(index=False)]
    assert sorted(plain, key=key) == sorted(want, key=key)
    for _, sequence in got.sort_values("offset").groupby("sequence_id"):
        assert (sequence.offset == sequence.length.cumsum() - sequence.length).all() and sequence.length.sum() <= 1024
    bins = []
    for n in sorted(got.length, reverse=True):  # best-fit decreasing is not better
        fit = [b for b in bins if b[0] >= n]
        best = min(fit) if fit else [1024]
        best[0] -= n
        bins += [] if fit else [best]
    assert got.sequence_id.nunique() <= len(bins)


def test_sequences_hold_the_ids(spark, rows):
    unique = [r for r in rows if r[0] not in (90, 91, None)]
    packer, docs = Packer(tokenizer_path(), capacity=256), frame(spark, unique)
    want, found, seen = dict(packed_ids(unique)), {}, set()
    for s in packer.sequences(docs).collect():
        assert 0 < len(s["ids"]) <= 256 and s["sequence_id"] not in seen and s["offsets"][0] == 0
        seen.add(s["sequence_id"])
        for d, p, a, z in zip(s["doc_ids"], s["pieces"], s["offsets"], [*s["offsets"][1:], len(s["ids"])]):
            found[d, p] = s["ids"][a:z]
    assert {i: sum((found[k] for k in sorted(found) if k[0] == i), []) for i in want} == want
    for r in packer.placed(docs).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]


def test_minimum_slack_fills_bins():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 35, 25, 100, 1]] = [5, 3, 4, 5, 2, 1]
    plan = minimum_slack(counts, 100)
    used = np.zeros(101, np.int64)
    for combination, bins in plan:
        assert sum(n * m for n, m in combination.items()) <= 100
        for n, m in combination.items():
            used[n] += m * bins
    assert (used == counts).all()
    assert fullest(np.array([0, 0, 0, 2, 0, 1]), 11) == {5: 1, 3: 2} and fullest(np.zeros(12, int), 11) == {}


def test_token_files(spark, rows):
    got = TokenFiles(tokenizer_path()).round_trip(frame(spark, rows))
    ids = sorted(packed_ids(rows), key=lambda r: -1 if r[0] is None else r[0])
    found = sorted(got.collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [i for i, _ in ids]
    total = 0
    for r in found:
        assert r["start"] == total
        total += r["n_tokens"]
    pair = lambda i, n, x: (str(i), n, x)
    assert sorted(pair(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == sorted(pair(i, len(x), crc(x)) for i, x in ids)


def test_simple8b_round_trip():
    r = np.random.default_rng(1)
    for bits in (1, 3, 8, 16, 20, 32, 59, 60, 61, 64):
        ids = r.integers(0, 1 << bits, 3000, dtype=np.uint64, endpoint=False) >> r.integers(0, bits, 3000).astype(np.uint64)
        counts = np.array([1, 0, 999, 2000])
        words, first = pack(ids, counts)
        assert (unpack(words) == ids).all()
        ends = np.cumsum(counts)
        for d, (n, e) in enumerate(zip(counts, ends)):
            stop = first[d + 1] if d < 3 else len(words)
            assert (unpack(words[first[d] : stop]) == ids[e - n : e]).all()
    assert len(pack(np.zeros(0, np.uint32), np.zeros(0, int))[0]) == 0


def test_encoder_cuts_nowhere_wrong():
    r = random.Random(3)
    texts = ["".join(r.choice(" \n\tab1.'é​\x1c\x85ퟻ漢") for _ in range(r.randint(0, 30))) for _ in range(800)]
    texts += ["", " ", "a ", "  a", "<|endoftext|> x", "don't  we'll"]
    ids, counts = Encoder(tokenizer_path()).encode(texts)
    ends = np.cumsum(counts)
    for (_, want), n, e in zip(packed_ids([(0, t) for t in texts]), counts, ends):
        assert ids[e - n : e].tolist() == want


def test_encoder_keeps_words_met_again_and_little_else():
    tool, learned = Encoder(tokenizer_path(), known_chars=2000), []
    library = tool._library
    tool._library = lambda texts: learned.append(str(texts)) or library(texts)
    for i in range(40):
        ids, counts = tool.encode([f"once{i} often again " + " ".join(f"w{i}x{j}" for j in range(50)), f"text{i} often"])
        assert ids[counts[0] :].tolist() == packed_ids([(0, f"text{i} often")])[0][1]
    assert sum("often" in str(x) for x in learned) == 1
    assert tool.known.chars < 4000 and len(tool.known.ids) <= 1 << 14


def test_added_tokens_get_the_ids_of_the_librarys_call(spark):
    library = Tokenizer.from_file(tokenizer_path())  # unmodified
    r = random.Random(4)
    parts = ["<|endoftext|>", "<|endoftext|", " ", "  ", "\n", "a b", "é", "don't", "w1 w2 "]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 12)))) for i in range(300)]
    rows += [(300, "a <|endoftext|> b"), (301, "a  <|endoftext|>"), (302, "<|endoftext|> " + prose(1, 1500)), (303, None)]
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    assert want[300] == [64, 220, 50256, 275, 2]
    ids, counts = Encoder(tokenizer_path(), as_text=False).encode([t or "" for _, t in rows])
    ends = np.cumsum(counts)
    assert all(ids[e - n : e].tolist() == want[i] for (i, _), n, e in zip(rows, counts, ends))
    found = {d["doc_id"]: (d["n_tokens"], d["ids_crc32"]) for d in TokenFiles(tokenizer_path()).round_trip(frame(spark, rows)).collect()}
    assert found == {i: (len(x), crc(x)) for i, x in want.items()}
    packed = Packer(tokenizer_path()).packed(frame(spark, rows)).collect()
    for p in packed:
        assert p["ids_crc32"] == crc(want[p["doc_id"]][p["start"] : p["start"] + p["length"]])
    assert sum(p["length"] for p in packed) == sum(map(len, want.values()))


def test_quality(spark, rows):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = LineFrequency(host="source").judged(frame(spark, rows))
    same(got, quality(rows), *columns)


def test_boilerplate_lines(spark):
    line = " ".join(f"menu{i}" for i in range(60))
    thin = [(i, f"{line}\nonly {i}") for i in range(8)]
    rich = [(100 + i, f"{line}\n{prose(i, 90, 100_000)}") for i in range(4)]
    judged = {r["doc_id"]: r for r in LineFrequency(max_texts=10).judged(frame(spark, thin + rich + thin[:2])).collect()}
    assert judged[0]["kept"] and not any(judged[i]["kept"] for i in range(1, 8)) and all(judged[100 + i]["kept"] for i in range(4))
    assert judged[1]["n_removed"] == 60 and judged[0]["n_removed"] == 0
    kept = LineFrequency(max_texts=10).accepted(frame(spark, thin + rich))
    assert {r["doc_id"] for r in kept.collect()} == {0, 100, 101, 102, 103}
    assert all(r["kept"] for r in LineFrequency(max_texts=12).judged(frame(spark, thin + rich)).collect())


def test_cleaned_texts_have_no_boilerplate(spark):
    line = " ".join(f"Menu{i}" for i in range(45))
    ends = [f"{line}\n{{}}", f"{{}}\n  {line.upper()} ", f"{{}}\n\n{line}\nlast one\n", "é {}"]
    own = {i: prose(i, 90, 100_000).strip() for i in range(1, 17)}
    rows = [(0, line)] + [(i, ends[i % 4].replace("{}", x)) for i, x in own.items()]  # 0 has 45 words: fails the base rules
    docs = frame(spark, [*rows, rows[1], (99, None)])
    got = sorted((r["doc_id"], r["text"]) for r in LineFrequency(max_texts=10).cleaned(docs).collect())
    cut = ["{}", "{}", "{}\n\nlast one\n", "é {}"]
    want = [(i, (ends if i == 1 else cut)[i % 4].replace("{}", x)) for i, x in own.items()]  # 1 is the first that passes
    assert got == sorted([*want, want[0]])
    assert LineFrequency(max_texts=10).cleaned(docs).columns == docs.columns
    old = LineFrequency(max_texts=10, first_passing=False).judged(docs).filter("doc_id = 1").first()
    assert old["n_removed"] == 45


def test_pipeline_passes_no_boilerplate_on(spark):
    import corpus_pipeline

    line = " ".join(f"menu{i}" for i in range(20))
    docs = frame(spark, [(i, f"{line}\n{prose(i, 90, 100_000)}") for i in range(102)])
    texts = {r["doc_id"]: r["text"] for r in corpus_pipeline.quality(spark, docs, "").collect()}
    assert len(texts) == 102 and [i for i, t in texts.items() if "menu1" in t] == [0]


def test_toxicity(spark):
    r = random.Random(2)
    rows = [(i, prose(i, 60) + (" you scum " if i % 4 == 0 else " dear friend ") + prose(i + 9000, r.randint(5, 40))) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    docs = frame(spark, [*rows, (900, None), (901, ""), (5, rows[5][1])])
    model = ToxicityModel(Ftrl(l1=2.0))
    scores = model.score(docs, model.fit(docs, labels.filter(~held_out()))).collect()
    assert len(scores) == 403 and all(0 <= s["score"] <= 1 for s in scores)
    right = [(s["score"] >= 0.3) == (s["doc_id"] % 4 == 0) for s in scores if s["doc_id"] < 400 and zlib.crc32(str(s["doc_id"]).encode()) % 4 == 2]
    assert len(right) > 50 and np.mean(right) > 0.97
    none = model.score(docs, model.fit(docs, labels.limit(0)))
    assert {s["score"] for s in none.collect()} == {0.0}


def test_licences(spark):
    rows = [(i, prose(i, 60)) for i in range(60)]
    rows += [(100, prose(1, 30) + "\nReleased under the MIT License.\n" + prose(2, 30)), (101, "Licensed under the Apache License, Version 2.0."),
             (102, "He lost his driving license on the road."), (103, None), (104, ""), (100, "All rights reserved.")]
    found = sorted((r["doc_id"], r["family"]) for r in LicenseScanner().scanned(frame(spark, rows)).collect() if r["doc_id"] >= 100)
    assert found == [(100, "mit"), (100, "reserved"), (101, "apache"), (102, "unknown"), (103, "unknown"), (104, "unknown")]


def test_empty_tables(spark):
    docs = frame(spark, [])
    benchmark = spark.createDataFrame([], "item_id string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = ToxicityModel()
    for result in (
        ContextExtractor().extracted(docs), Decontaminator().judged(docs, benchmark), SubstringDedup().digested(docs),
        JaccardJoin().joined(docs), FactorDedup().digested(docs), Packer(tokenizer_path()).packed(docs),
        LicenseScanner().scanned(docs), model.score(docs, model.fit(docs, labels)), LineFrequency().judged(docs),
        TokenFiles(tokenizer_path()).round_trip(docs), ContextExtractor().redacted(docs), JaccardJoin().representatives(docs),
    ):
        assert result.collect() == []


def test_digests_are_of_bytes():
    assert sha("é") == sha("é".encode())


def test_words_that_collide_modulo_powers_of_two(spark):
    one = "a"
    for _ in range(10):
        one += one.translate(str.maketrans("ab", "ba"))  # a Thue-Morse word of 1,024 letters
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one), (2, other), (3, "w " * 12 + one), (4, "w " * 12 + other)]
    same(JaccardJoin().joined(frame(spark, rows)), jaccard(rows), "doc_id", "n_shingles", "component_id")
    same(SubstringDedup().digested(frame(spark, rows)), substrings(rows), "doc_id", "n_words", "n_removed", "kept_sha256")


def test_hash_tables_are_no_longer_than_chunks():
    column = pa.array(["ab cd " * 50_000] * 20)
    for size in (common.CHUNK, common.HALF):
        found = list(common.chunks(column, size))
        assert [f for f, *_ in found] == [0, *(e for _, e, *_ in found[:-1])] and found[-1][1] == 20
        assert all(len(common.powers(len(data) + 1)[1]) <= size + 1 for *_, data, _ in found)
