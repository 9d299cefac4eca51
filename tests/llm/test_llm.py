"""The training-data operators against plain versions, on edge cases and small tables."""

import hashlib
import random
import re
import struct
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import bpe, coder, decontaminate, hamming, language, lines, minhash, pii, quality, suffixes, token_files

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, hash string"
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE + " nineteen"), (4, None), (5, ""), (6, "   \n\t"), (7, "short one"), (8, "short one"),
    (9, "a b c d e"), (None, BASE), (None, None), (10, "l1\nl2\nl3\nl4\n" * 3), (11, "x\nl1\nl2\nl3\nl4\nl1\nl2\nl3\nl4\ny"), (12, "z" * 60 + "q"),
    (13, "é" * 40), (14, "w " * 5000), (1, BASE),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t, "en", "s", 1, "own", "h") for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def linked(rows):
    """component by id, brute force."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i, _ in sets}


@pytest.mark.parametrize("rows", [TEXTS, documents()], ids=["edge", "documents"])
def test_near_duplicates(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = minhash.near_duplicates(docs).collect()
    want = linked(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is None or want[r.doc_id] == r.doc_id)
    sizes = {i: len(shingles(t)) for i, t in rows}
    assert all(r.n_shingles == sizes[r.doc_id] for r in got if r.doc_id is not None)


def test_near_duplicates_family_below_the_threshold(spark):
    rnd = random.Random(5)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.choice((1, 2, 4, 6, 9))):
            w[rnd.randrange(200)] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == linked(rows)


def test_one_of_each_keeps_columns(edge):
    out = minhash.one_of_each(edge)
    assert out.columns == edge.columns
    ids = [r.doc_id for r in out.collect()]
    assert ids.count(None) == 2 and sorted(i for i in ids if i) == [1, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14]


def test_line_dedup_edges(spark, edge):
    out = {}
    for r in lines.dedup_lines(edge).collect():
        out.setdefault(r.doc_id, r)
    assert out[4].text is None and out[4].n_chunks is None and out[5].text == "" and out[5].n_chunks == 1
    assert out[1].text == BASE and out[2].text == BASE  # one line is no multi-line chunk
    assert out[12].text == "z" * 60 + "q" and out[10].n_removed > 0
    assert lines.without_repeats(edge).columns == edge.columns
    twice = spark.createDataFrame([(1, "a\nb\nc\nd\ne"), (2, "a\nb\nc\nd\ne"), (3, None)], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in lines.without_repeats(twice, modulus=10**9).collect()) == [1, 3]


def runs_removed(rows):
    """What is left of each text, brute force: every line of a pair of lines that stood before goes."""
    seen, out = set(), {}
    for i, t in sorted({r for r in rows if r[0] is not None and r[1] is not None}):
        part = t.split("\n")
        gone = set()
        for k in range(len(part) - 1):
            pair = (part[k], part[k + 1])
            if re.search(r"\S", "".join(pair)):
                gone |= {k, k + 1} if pair in seen else set()
                seen.add(pair)
        left = "\n".join(x for k, x in enumerate(part) if k not in gone)
        if left or not gone:
            out[i] = left
    return out


@pytest.mark.parametrize("key", [lines.F.xxhash64, lambda x: lines.F.length(x).cast("bigint")], ids=["hash", "clashing"])
def test_repeated_runs_go_whole(spark, key):
    rnd = random.Random(7)
    runs = [[f"run {r} line {k}" for k in range(2 + r % 3)] for r in range(30)]
    rows = [(i, "\n".join([f"own {i} a", *runs[i % 30], f"own {i} b", *rnd.choice(runs), f"own {i} c"])) for i in range(20, 120)]
    rows += [*TEXTS, *documents(), (200, "a\na\na\na"), (201, "\n \n\n \n"), (202, "\n \n\n \n"), (203, "one\n"), (204, "two\n\none\n")]
    rows = [(k if i is not None else None, t) for k, (i, t) in enumerate(rows)]
    rows.append(rows[0])
    want = runs_removed(rows)
    got = lines.without_repeated_runs(spark.createDataFrame(rows, "doc_id bigint, text string"), key).collect()
    assert {r.doc_id: r.text for r in got if r.doc_id is not None and r.text is not None} == want
    assert len(got) == len(want) + 1 + sum(i is None or t is None for i, t in rows)
    left = "\n".join(text for i, text in want.items() if i < 100)
    assert all(left.count(x) <= 1 for run in runs for x in run)


def test_repeated_runs_of_rows_that_share_an_id(spark):
    rows = [(1, "a\nb\nc"), (2, "x\na\nb"), (2, "p\nq\nr"), (3, "p\nq\ns")]
    got = lines.without_repeated_runs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(tuple(r) for r in got) == [(1, "a\nb\nc"), (2, "p\nq\nr"), (2, "x"), (3, "s")]


def test_suffix_dedup(spark):
    rows = [*TEXTS[:8], *TEXTS[11:16], *documents()[50:120]]
    rows = [(k if i is not None else None, t) for k, (i, t) in enumerate(rows)] + [(None, BASE)]
    got = {r.doc_id: r for r in suffixes.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    seen = {}
    for i, t in rows:
        if i is None:
            continue
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if seen.setdefault(b[k : k + 50], i) < i:
                gone[k : k + 50] = b"\1" * 50
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.kept_sha256, bytes(r.kept_bytes)) == (len(b), sum(gone), hashlib.sha256(rest).hexdigest(), rest)
        assert r.n_spans == len(re.findall(b"\1+", bytes(gone)))
    assert got[None].n_removed == 0


def test_top_k(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.choice((-1.0, 1.0)) for _ in range(20)]) for i in range(300)] + [(300, None), (None, [1.0] * 20), (301, [])]
    rows += [(400 + i, [1.0] * 20) for i in range(30)]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in hamming.nearest(v, v.where("vec_id % 100 = 0"), k=5).collect():
        got.setdefault(r.query_id, []).append((r.distance, r.id))
    good = [(i, x) for i, x in rows if i is not None and x]
    for i, x in good:
        if i % 100 == 0:
            assert sorted(got[i]) == sorted((sum(a != b for a, b in zip(x, y, strict=True)), j) for j, y in good if j != i)[:5]


def test_decontamination(spark):
    bench = spark.createDataFrame([(1, BASE), (2, "alpha beta gamma delta epsilon zeta eta"), (3, ""), (4, None), (None, BASE)], "item_id bigint, text string")
    words = BASE.upper().split()
    some = list(words)
    some[4] = some[9] = "other"
    many = list(words)
    for k in range(0, 18, 3):
        many[k] = f"no{k}"
    rows = [(1, "clean text of many words " * 20), (2, "x y z " + " ".join(some) + " tail"), (3, " ".join(many)), (4, None), (5, "Alpha beta gamma DELTA epsilon zeta eta theta"), (6, "alpha beta gamma"), (None, BASE)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()} == {(2, 1), (5, 2)}
    assert sorted(r.doc_id or 0 for r in decontaminate.clean(docs, bench).collect()) == [0, 1, 3, 4, 6]


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    out = language.identify(docs).collect()
    held = [r for r in out if r.held_out]
    assert held and all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out and 0 <= r.score <= 1 for r in out)
    assert np.mean([r.lang_pred == rows[r.doc_id].lang for r in held]) > 0.95


def test_near_duplicates_with_small_and_large_buckets(spark, monkeypatch):
    # Chains of texts of which neighbours are alike and others are not, so that buckets hold several components after the hubs' round.
    rnd = random.Random(2)
    words, docs = [f"w{rnd.randrange(400)}" for _ in range(60)], []
    for i in range(160):
        words = [f"w{rnd.randrange(400)}" if rnd.random() < 0.03 else w for w in words] if i % 40 else [f"w{rnd.randrange(400)}" for _ in range(60)]
        docs.append((i, " ".join(words)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(56)} for i, t in docs}
    first = {i: i for i, _ in docs}
    for a in range(160):
        for b in range(a + 1, 160):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                lo, hi = sorted((first[a], first[b]))
                first = {i: lo if c == hi else c for i, c in first.items()}
    assert 4 < len(set(first.values())) < 156
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    for small in (1, 3, 1000):  # equal buckets are looked for in none, in some, in all
        monkeypatch.setattr(minhash, "SMALL", small)
        assert {r.doc_id: r.component_id for r in minhash.near_duplicates(table).collect()} == first


def test_language_trees_come_in_small_rows(spark):
    # One large row is held several times over by the driver's JVM; here no row and no task's result is large.
    rnd = random.Random(1)
    docs = [(i, "".join(rnd.choices([chr(x) for x in range(32, 120 + i % 3)], k=3000)), ("aa", "bb", "cc")[i % 3]) for i in range(60)]
    docs = [x for x in docs if zlib.crc32(str(x[0]).encode()) % 4 != language.HELD_OUT]
    batch = pa.RecordBatch.from_pydict({"doc_id": [x[0] for x in docs], "lang": [x[2] for x in docs], "text": [x[1] for x in docs]})
    found = [r for b in language._fit(language.ALPHABET, language.CONTEXTS)(iter([batch])) for r in b.to_pylist()]
    assert len(found) > 3 and max(len(r["trees"]) for r in found) <= 1 << 17
    raw = b"".join(r["trees"] for r in found)
    assert language.Trees.restore(raw).langs == ["aa", "bb", "cc"]
    assert language.learn(spark.createDataFrame(docs, "doc_id bigint, text string, lang string")) == raw


def test_coder_round_trip():
    rnd = np.random.default_rng(0)
    blocks = [rnd.integers(0, 500, n) for n in (1, 2, 700, 3000)] + [np.zeros(2000, int), np.tile([5, 7, 9], 900)]
    packed = coder.encode_blocks(blocks, 500)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, coder.decode_blocks(packed, [len(b) for b in blocks], 500), strict=True))
    assert len(packed[-1]) < 400


def test_token_files(spark, edge):
    tool = bpe.encoder(bpe.public(token_files.WORD_BPE)).whole
    files = token_files.write(edge)
    start = 0
    got = sorted(token_files.read(files).collect(), key=lambda r: r.start)
    assert len(got) == len(TEXTS) and [r.doc_id for r in got if r.doc_id] == sorted(i for i, _ in TEXTS if i)
    texts = dict(TEXTS)
    for r in got:
        assert r.start == start
        start += r.n_tokens
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
        if r.doc_id:
            assert r.ids == [*tool.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
    raw = bytearray(files.first().file)
    raw[-3] ^= 255
    with pytest.raises(ValueError, match="damaged"):
        token_files.unpack(bytes(raw))


def test_token_files_are_read_once(spark, edge):
    """the join of the files' starts shuffled the documents, and its late change to a broadcast read all files again."""
    plan = token_files.read(token_files.write(edge), whole=False)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(part#\d+, seq#\d+", plan) and "SortMergeJoin" not in plan


def test_coder_is_wide():
    """a lane had tables of the whole vocabulary, so 384 lanes filled the memory; a block's lanes share one model now."""
    ids = np.random.default_rng(1).zipf(1.3, 300_000) % 49_000
    tracemalloc.start()
    (packed,) = coder.encode_blocks([ids], 49_408)
    assert tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()
    assert np.array_equal(coder.decode_blocks([packed], [len(ids)], 49_408)[0], ids)


def test_word_bpe_is_the_library():
    rnd = random.Random(5)
    chars = [*"'aBst1!é \n\tñÀ×÷ßÿΣ", "'ll", "'RE", "'v", "e\u0301", "\x1c", "\x85", "\xa0", "漢", "\u1c89", "\ua7cb", "\u0558", "İ"]
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    texts += [f"{chr(c)}a'{chr(c)}S x{chr(c)}'ll 1{chr(c)}" for c in range(1, 0x800)]
    texts += ["", "''s", "don't", "x" * 5000, "a<|endoftext|>b", "<|ENDOFTEXT|> b"]
    tool = bpe.encoder(bpe.public(token_files.WORD_BPE))
    for given in (texts, pa.array(texts), pa.array([x for x in texts if "<|" not in x])):
        ids, off = tool.encode(given)
        want = tool.whole.encode_batch(given if isinstance(given, list) else given.to_pylist(), add_special_tokens=False)
        assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == [x.ids for x in want]


def test_bpe_is_the_library(spark):
    rnd = random.Random(3)
    chars = "abé \n\t '0d9!漢字😀trs  "
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randrange(80))) for _ in range(300)]
    texts += ["".join(rnd.choice("abcdxyzq") for _ in range(n)) for n in (255, 257, 9000)] + ["".join(rnd.choice(chars) for _ in range(40_000)), "a<|endoftext|>b", " " * 20_000 + "x", ""]
    tool = bpe.encoder(bpe.public(bpe.BYTE_BPE))
    ids, off = tool.encode(texts)
    for k, x in enumerate(tool.whole.encode_batch(texts, add_special_tokens=False)):
        assert ids[off[k] : off[k + 1]].tolist() == x.ids
    assert tool.decode(ids, off) == texts


def test_pii_base_and_disguised():
    base, every = pii.find("bob at example dot com, a@b.co, 1.2.3.4, 1.2.3.400, +49 151 2345678")
    assert base["email"] == [(24, 30)] and every["email"] == [(0, 22), (24, 30)] and base["ip"] == [(32, 39)] and len(base["phone"]) == 1
    card = "four one one one " + "one one one one " * 3
    assert pii.find(card)[1]["card"] == [(0, len(card.rstrip()))]
    assert pii.find("") == ({k: [] for k in pii.KINDS}, {k: [] for k in pii.KINDS})


@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [(f"write to {x} now", "email", x) for x in (
        "jane [at] example dot com", "jane at example [dot] com", "jane@example dot com", "jane dot doe at example dot com", "jane  at  example  dot  com",
        "jane.doe (at) example.co dot uk", "jane at example.com", "a" * 80 + " at " + "dot ".join(f"h{k} " for k in range(9)) + "dot " + "t" * 30,
    )]
    + [(f"from {x} on", "ip", x) for x in ("10 dot 0 dot 0 dot 1", "one zero dot zero dot zero dot one", "192.168.one.two", "10 [dot] 0 dot 0.one")]
    + [(f"call {x} now", "phone", x) for x in ("+49 151 two three four 5678", "+49 one five one 2345678")]
    + [("card 4111 1111 1111 one one one one, ok", "card", "4111 1111 1111 one one one one")],
)
def test_pii_mixed_disguises(text, kind, part):
    base, every = pii.find(text)
    assert part in [text[a:b] for a, b in every[kind]] and not base[kind]


def test_pii_plain_words_are_no_disguise():
    for text in ("we met at 5.30 on day one. Two came", "the dot at the end", "pick one or two", "look at one. It is at home"):
        assert not any(pii.find(text)[1].values()), text


def test_quality_learns_words_that_are_rare_in_a_quarter_of_the_labels(spark):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("bcdfghklmnprstvz") for _ in range(9)) for _ in range(300)]
    rows = [(i, f"plain text number n{i % 97} of {rnd.randrange(10**6)} words {words[i // 5 % 300] if i % 5 == 0 else ''.join(rnd.choice('bcdfghklmnprstvz') for _ in range(9))}") for i in range(12_000)]
    rows += [(20_000 + k, f"plain text number n{k % 97} of {rnd.randrange(10**6)} words {w}") for k, w in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(12_000)], "doc_id bigint, quality int, toxic int")
    model = quality.learn(docs, labels)["toxic"]
    held = [t for i, t in rows if i >= 20_000]
    shape, found = quality.features(np.frombuffer("".join(held).encode(), np.uint8), np.r_[0, np.cumsum([len(t) for t in held])])
    odds = model.evidence(shape, found, model.table()) + model.prior
    assert np.mean(1 / (1 + np.exp(-odds)) >= quality.TOXIC) > 0.95


def test_quality(spark):
    rows = [(i, ("good plain words here " if i % 2 else "BAD!! JUNK!! ") * 8 + ("moron" if i % 10 == 0 else ""), "en", f"s{i % 3}") for i in range(200)]
    rows += [(900, None, None, None), (None, "good plain words", "en", "s1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    labels = spark.createDataFrame([(i, i % 2, int(i % 10 == 0)) for i in range(150)], "doc_id bigint, quality int, toxic int")
    out = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    assert len(out) == 202
    assert all((out[i].p_quality > 0.5) == bool(i % 2) for i in range(200))
    assert all(out[i].kept == bool(i % 2) for i in range(150, 200))
    nothing = quality.score(docs, labels.limit(0)).collect()
    assert len(nothing) == 202 and all(0 <= r.p_quality <= 1 for r in nothing)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for out in (
        minhash.near_duplicates(empty), minhash.one_of_each(empty), lines.without_repeats(empty), suffixes.without_repeats(empty), language.identify(empty),
        language.known_language(empty), pii.personal_data(empty), pii.redacted(empty), bpe.encode(empty), bpe.encoded_documents(empty), token_files.read(token_files.write(empty)),
        decontaminate.clean(empty, empty.withColumnRenamed("doc_id", "item_id")), quality.score(empty, labels),
    ):
        assert out.count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF).collect()
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert out and {r.doc_id for r in out} <= set(rows) and len({r.doc_id for r in out}) == len(out)
    assert all(len(r.token_ids) == r.n_tokens for r in out)


def test_columns_of_any_name(spark):
    """Names that are no identifiers, and those that an operator gives its own columns."""
    names = ["doc_id", "text", "lang", "a-b", "a b", "n_tokens", "TOKEN_IDS", "lang_pred", "score", "row"]
    docs = spark.createDataFrame([(1, "write to jo@example.com", None, 1, 2, 3, 4, 5, 6, 7)], "doc_id long, text string, lang string, " + ", ".join(f"`{n}` int" for n in names[3:]))
    (red,) = pii.redacted(docs).collect()
    assert red.text == "write to <email>" and list(red.asDict()) == names and tuple(red)[3:] == (1, 2, 3, 4, 5, 6, 7)
    learnt = docs.unionByName(docs.selectExpr("2L AS doc_id", "text", "'en' AS lang", *[f"`{n}`" for n in names[3:]]))
    assert {r.lang for r in language.known_language(learnt).collect()} == {"en"}
    (enc,) = bpe.encoded_documents(docs).collect()
    assert list(enc.asDict()) == ["doc_id", "lang", "a-b", "a b", "lang_pred", "score", "row", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256"]
    assert enc.n_tokens == len(enc.token_ids) > 3
    assert bpe.encoded_documents(spark.createDataFrame([("x",)], "text string").selectExpr("1 AS doc_id", "text").drop("doc_id").selectExpr("text", "1L AS doc_id")).count() == 1


def test_long_text_keeps_offsets_in_arrays():
    long = "lorem ipsum dolor " * 200_000 + "mail jane [at] example [dot] com now"
    _, every = pii.find(long)
    start = long.index("jane")
    assert every["email"] == [(start, len(long) - 4)]


def test_words_made_to_collide_stay_apart(spark):
    """A sequence that doubles by its complement, and its complement, collide in any polynomial modulo 2**64."""
    a, b = "a", "b"
    for _ in range(12):
        a, b = a + b, b + a
    rows = [(1, a), (2, b), (3, f"{a} x y z"), (4, f"{b} x y z"), (5, a.upper())]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}
