"""The registered corpus queries against brute force, on a small corpus of awkward rows."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import difference
from tidemark.llm import bpe_codec, fingerprints, jaccard, packing, pii, queries, repair, tokens

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def rows(spark, name, folder):
    return [r.asDict() for r in queries.QUERIES[name](spark, folder).collect()]


@pytest.fixture(scope="module")
def texts(spark, corpus):
    found = spark.read.parquet(f"{corpus}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r["doc_id"], r["text"] or "") for r in found)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert rows(spark, name, empty) == []


def test_quality_base(spark, corpus, texts):
    got = sorted(rows(spark, "op1_quality_llr", corpus), key=lambda r: r["doc_id"])
    for (doc_id, t), r in zip(texts, got, strict=True):
        w = SPLIT.findall(t)
        windows = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if windows[g] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if SPLIT.search(x)]
        want = (doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        assert (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r["base_failed"] and r["kept"])
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert kept[4] and kept[7] and not kept[12] and not kept[13]


def test_repair_round_trip(spark, corpus, texts, library):
    want, start = [], 0
    for doc_id, t in texts:
        ids = library.encode(t, add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = rows(spark, "op2_repair_ids", corpus)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


def test_grammar_random_access():
    dice = np.random.default_rng(1)
    ids = np.concatenate([np.tile([5, 6, 7, 5, 6], 400), dice.integers(0, 9, 3000)]).astype(np.uint32)
    ends = np.asarray([700, 2500, len(ids)])
    g = repair.compress(ids, ends)
    assert len(g.rules) and len(g.symbols) < len(ids)
    assert (repair.expand(g.symbols, g.rules) == ids).all()
    assert (repair.tokens_at(g, 1, 33, 500) == ids[733:1233]).all()


def test_a_grammar_is_opened_once():
    """Each rule is opened once for a block, and no frequent pair is left, also of pairs that share a slot."""
    dice = np.random.default_rng(3)
    for n in (1, 2, 40, 3000):
        ids = dice.integers(0, 7, n).astype(np.uint32)
        g = repair.compress(ids, np.unique([1, -(-n // 2), n]))
        assert (repair.expand_all(g) == ids).all() and (repair.expand(g.symbols, g.rules) == ids).all()
        inside = ~np.isin(np.arange(1, len(g.symbols)), g.ends)
        left = Counter(zip(g.symbols[:-1][inside].tolist(), g.symbols[1:][inside].tolist()))
        assert max(left.values(), default=0) < repair.LEAST_FREQUENCY


@pytest.mark.parametrize("parts", [
    [" a", " b", " "], [" a\n", " ", " b"], [" a\u00a0", " \u00a0b", " c"], [" a b", "c"], [" a\0 b", "c", ""], ["", " a"], [" ", " "], [" \x1cx", " y\x1f"],
    [" a", "<|endoftext|>", " b"], [" \u0120x", " \u00c3\u0120"], ["a", "b"], [" x's", " 's", " 12ab", " \n", " \té"]])
def test_joined_chunks_are_cut_where_they_were(library, parts):
    """Ids of texts encoded in one call are those of each alone, cut at their spaces or, where those do not tell, at marks."""
    encode = tokens.library_encoder(tokens.vocabulary())._encode
    for some in (parts, parts[::-1], [" w", *parts] * 400):
        assert encode(some) == [np.asarray(library.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in some]


def test_chunks_with_one_space_need_no_marks(monkeypatch):
    from tokenizers import Tokenizer

    class Seen:
        def __init__(self, tool):
            self.tool, self.texts = tool, []

        def __getattr__(self, name):
            return getattr(self.tool, name)

        def encode_batch_fast(self, texts, **options):
            self.texts += texts
            return self.tool.encode_batch_fast(texts, **options)

    seen = Seen(Tokenizer.from_file(tokens.vocabulary()))
    monkeypatch.setattr("tokenizers.Tokenizer", type("Loaded", (), {"from_file": staticmethod(lambda path: seen)}))
    encode = tokens.library_encoder.__wrapped__(tokens.vocabulary())._encode
    assert len(encode([" ab", " cd"] * 300)) == 600 and not any("<|endoftext|>" in t for t in seen.texts)
    assert len(encode(["ab", " cd"])) == 2 and "<|endoftext|>" in seen.texts[-1]


def test_a_chunk_is_looked_up_once_a_batch(library):
    class Counted(dict):
        looked = 0

        def get(self, key):
            self.looked += 1
            return super().get(key)

    encode = lambda parts: [np.asarray(e.ids, "<u4").tobytes() for e in library.encode_batch(parts, add_special_tokens=False)]
    encoder = tokens.ChunkEncoder(encode, ["<|endoftext|>"])
    encoder._inner[0] = counted = Counted()
    assert encoder(["a b b c"] * 50 + [None]) == encode(["a b b c"]) * 50 + [b""]
    assert counted.looked <= 4  # a, b, c and the empty text
    dice, letters = random.Random(5), [*"  aB1!\n\t\x0b\x0c\r\x1c\x1f\x85\xa0\u1680\u180e\u2009\u2028\u200b\u3000é東", "🙂", "'s", "<|endoftext|>"]
    odd = ["".join(dice.choices(letters, k=dice.randint(0, 25))) for _ in range(5000)]
    assert encoder(odd) == encode(odd)


def test_passages_and_jaccard_by_sql(spark, corpus):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT DISTINCT * FROM read_parquet('{corpus}/documents.parquet/*.parquet')")
    for name in ("op3_phrase_automata", "op5_trie_jaccard"):
        assert difference(queries.QUERIES[name](spark, corpus).distinct(), con, queries.SQL[name]) is None


def test_language(spark, corpus, texts):
    got = {r["doc_id"]: r for r in rows(spark, "op4_crf_language", corpus)}
    assert [got[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and got[4]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())


def test_packing(spark, corpus, texts, library):
    got = rows(spark, "op6_best_fit_packing", corpus)
    fill = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= 1024
    want = []
    for doc_id, t in texts:
        ids = library.encode(t, add_special_tokens=False).ids + [2]
        want += [(doc_id, k, a, n, crc(ids[a:a + n])) for k, (a, n) in enumerate(packing.cut(len(ids)))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    assert len(fill) <= -(-sum(r["length"] for r in got) // 1024) + 1


def test_packing_rounds_move_whole_bins(spark, monkeypatch):
    """Many small buckets: bins that go up keep their content gapless."""
    monkeypatch.setattr(packing, "BUCKET_PIECES", 3)
    items = spark.range(200).selectExpr("id AS row_id", "id AS doc_id", "0 AS piece", "0L AS start", "(id * 37) % 500 + 1 AS length", "0L AS ids_crc32")
    fill = {}
    for r in sorted(packing.best_fit(items).collect(), key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= 1024 and len(fill) < 67


def test_fingerprints(spark, corpus, texts):
    got = sorted(rows(spark, "op7_weighted_sampling", corpus), key=lambda r: r["doc_id"])
    for i, ((doc_id, t), r) in enumerate(zip(texts, got, strict=True)):
        other, q = texts[(i + 1) % len(texts)][1], len(t) // 4
        assert (r["doc_id"], r["n_chars"], r["edited_sha256"]) == (doc_id, len(t), sha(t[:len(t) - q] + other[:q]))
    by = {r["doc_id"]: r for r in got}
    assert by[4]["fingerprint"] == by[5]["fingerprint"] and by[4]["near_next"] == 1.0
    assert by[0]["fingerprint"] == "" and by[5]["near_next"] > 0.8 and by[7]["near_next"] < 0.35

    def bag(text):
        return Counter(zip(["", *SPLIT.findall(text)], SPLIT.findall(text)))

    t, q = texts[10][1], len(texts[10][1]) // 4
    a, b = bag(t), bag(t[:len(t) - q] + texts[11][1][:q])
    exact = sum((a & b).values()) / sum((a | b).values())  # an estimate is within four deviations of it
    assert abs(by[10]["near_edited"] - exact) < 4 * (exact * (1 - exact) / fingerprints.BINS) ** 0.5


def test_texts_are_shuffled_once_for_fingerprints(spark, corpus):
    plan = fingerprints.fingerprint_pairs(spark.read.parquet(f"{corpus}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(part") == 1


def test_fingerprint_share_is_the_generalised_jaccard(spark):
    dice = np.random.default_rng(2)
    a = dice.integers(0, 300, 4000)
    b = np.where(dice.random(4000) < 0.3, dice.integers(0, 300, 4000), a)
    bags = [Counter(zip(["", *map(str, x)], map(str, x))) for x in (a, b)]
    exact = sum((bags[0] & bags[1]).values()) / sum((bags[0] | bags[1]).values())
    df = spark.createDataFrame([(" ".join(map(str, a)), " ".join(map(str, b)))], "a string, b string")
    sig = [fingerprints.signature(df[c], 512) for c in "ab"]
    assert abs(df.select(fingerprints.likeness(*sig).alias("x")).first()["x"] - exact) < 0.08


def _numbered(n, seed):
    return " ".join(f"{seed}x{k}" for k in range(n))


@pytest.mark.parametrize(("a", "b"), [
    ("same " * 1000 + _numbered(100, 1), "same " * 1000 + _numbered(100, 2)),
    ((_numbered(8, 1) + "\n") * 60 + _numbered(150, 2), (_numbered(8, 1) + "\n") * 60 + _numbered(150, 3)),
    (_numbered(3000, 1), _numbered(3000, 1) + " " + _numbered(2000, 2))])
def test_fingerprints_of_repeated_phrases(spark, a, b):
    """Skewed weights, and more terms than are drawn at a time, at the registered samples: the mean over 20 renamed pairs of texts."""
    bags = [Counter(zip(["", *x], x)) for x in (a.split(), b.split())]
    exact = sum((bags[0] & bags[1]).values()) / sum((bags[0] | bags[1]).values())
    pairs = [tuple(" ".join(f"{w}y{i}" for w in x.split()) for x in (a, b)) for i in range(20)]
    df = spark.createDataFrame(pairs, "a string, b string")
    alike = fingerprints.likeness(*[fingerprints.signature(df[c]) for c in "ab"])
    got = [r["x"] for r in df.select(alike.alias("x")).collect()]
    assert abs(np.mean(got) - exact) < 4 * (exact * (1 - exact) / (20 * fingerprints.BINS)) ** 0.5


@pytest.mark.parametrize("n", [1, 3, 500, 3000])
def test_left_out_draws_never_win(n):
    """Samples with a limit on the draws looked at are those of all draws."""
    dice = np.random.default_rng(n)
    terms = np.unique(dice.integers(1, 1 << 63, n).astype(np.uint64))
    weights = np.where(dice.random(len(terms)) < 0.2, dice.integers(1, 2000, len(terms)), 1)
    salts = fingerprints.mix(np.arange(1, 65, dtype=np.uint64) * fingerprints._STEP)
    _, chosen, step = fingerprints._least(terms, weights, salts, np.inf)
    ids = fingerprints.mix(chosen + step.astype(np.uint64) * fingerprints._STEP) & np.uint64(0xFFFFFFFF)
    assert (fingerprints.samples(terms, weights) == (np.arange(64) << 32) + ids.astype(np.int64)).all()


def _bag(text):
    return Counter(zip(["", *SPLIT.findall(text)], SPLIT.findall(text)))


def test_fingerprints_of_the_query_run_no_python(spark, corpus):
    plan = fingerprints.fingerprint_pairs(spark.read.parquet(f"{corpus}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "MapInArrow" not in plan


def test_word_pairs_are_counted_by_columns(spark, texts):
    odd = list(enumerate([*(t for _, t in texts), " \n\t\x0b\x0c\r ", " a  a\ta\nb\u00a0c a a ", "\x1fx", None]))
    rows = fingerprints.term_runs(spark.createDataFrame(odd, "doc_id long, text string"), ["doc_id"]).collect()
    found = {}
    for r in rows:
        found.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in odd:
        bag = _bag(text or "")
        if not bag:
            assert [r["term"] for r in found[doc_id]] == [None]
            continue
        assert sorted(r["weight"] for r in found[doc_id]) == sorted(bag.values())
        assert {r["total"] for r in found[doc_id]} == {sum(bag.values())} and len({r["term"] for r in found[doc_id]}) == len(bag)


def _drawn(spark, pairs, **options):
    """Samples by columns of both texts of each pair."""
    found = spark.createDataFrame([(i, k, x) for i, p in enumerate(pairs) for k, x in enumerate(p)], "i int, k int, text string")
    out = [(set(), set()) for _ in pairs]
    for r in fingerprints.drawn(found, ["i", "k"], **options).collect():
        out[r["i"]][r["k"]].add(r["sample"])
    return out


@pytest.mark.parametrize(("a", "b"), [
    ("same " * 1000 + _numbered(100, 1), "same " * 1000 + _numbered(100, 2)),
    ("same " * 1000 + _numbered(300, 1), "same " * 300 + _numbered(300, 1)),
    ((_numbered(8, 1) + "\n") * 60 + _numbered(150, 2), (_numbered(8, 1) + "\n") * 45 + _numbered(150, 3)),
    (_numbered(3000, 1), _numbered(3000, 1) + " " + _numbered(2000, 2))])
def test_column_draws_agree_with_the_generalised_jaccard(spark, a, b):
    bags = [_bag(x) for x in (a, b)]
    exact = sum((bags[0] & bags[1]).values()) / sum((bags[0] | bags[1]).values())
    pairs = [tuple(" ".join(f"{w}y{i}" for w in x.split()) for x in (a, b)) for i in range(20)]
    got = _drawn(spark, pairs)
    assert all(len(x) == fingerprints.BINS for p in got for x in p)
    alike = np.mean([len(x & y) / fingerprints.BINS for x, y in got])
    assert abs(alike - exact) < 4 * (exact * (1 - exact) / (20 * fingerprints.BINS)) ** 0.5


def test_column_draws_left_out_never_win(spark):
    """Samples with a limit on the draws looked at are those of all draws."""
    dice = np.random.default_rng(5)
    pairs = [(" ".join(map(str, dice.integers(0, 9, 400))), " ".join(map(str, dice.integers(0, 2000, 900)))) for _ in range(3)]
    assert _drawn(spark, pairs) == _drawn(spark, pairs, likely=1000.0)


def test_personal_data(spark, corpus, texts):
    got = {r["doc_id"]: r for r in rows(spark, "op8_pii_spans", corpus)}
    r, t = got[11], dict(texts)[11]
    spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(","))]
    assert [(k, t[a:b]) for k, a, b in spans] == [
        ("email", "joe@example.org"), ("phone", "+49 30 1234567"), ("card", "4111 1111 1111 1111"), ("ip", "10.0.0.3")]
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 1) and r["base_sha256"] == sha(r["spans"])
    assert got[15]["spans"] == "iban:5:32" and got[0]["spans"] == ""
    assert pii.redact(t, pii.spans_of(t)).count("<") == 4 and pii.mod_97("GB82WEST12345698765432")


BASE_PATTERNS = {  # of the contract
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_base_spans(text):
    valid = {"ip": lambda m: all(int(p) <= 255 for p in m.split(".")), "email": lambda m: True,
             "card": lambda m: 12 <= sum(c.isdigit() for c in m) <= 19 and pii.luhn(m),
             "phone": lambda m: 9 <= sum(c.isdigit() for c in m) <= 15}
    return [(k, m.start(), m.end()) for k, p in BASE_PATTERNS.items() for m in re.finditer(p, text) if valid[k](m[0])]


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(11)
    alphabets = ["ab@.-_ 1", "0123456789.+ -()", "a@b.c-", "12.", "é1@.a+ -9"]
    for i in range(4000):
        text = "".join(rng.choices(alphabets[i % len(alphabets)], k=rng.randint(1, 60)))
        found = sorted(s[:3] for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS)
        assert found == sorted(plain_base_spans(text)), text


@pytest.mark.parametrize("text", ["a-" * 500_000, "1" * 1_000_000 + ".", "1." * 500_000, "a" * 1_000_000 + "@", "@" * 1_000_000,
                                  "a@b" * 300_000, "0" * 5001 + ".1.2.3", "+1" + "(" * 1_000_000, "AB12" * 250_000])
def test_long_runs_take_linear_time(text):
    started = time.perf_counter()
    spans = pii.spans_of(text)
    assert time.perf_counter() - started < 10
    assert ("ip", 0, 5007) in [s[:3] for s in spans] or not text.startswith("00")


def test_bpe_is_the_librarys(spark, corpus, texts, library):
    got = {r["doc_id"]: r for r in rows(spark, "op9_bpe_codec", corpus)}
    for doc_id, t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert (got[doc_id]["n_tokens"], got[doc_id]["ids_sha256"], got[doc_id]["decoded_sha256"]) == (
            len(ids), sha(",".join(map(str, ids))), sha(t))
        assert bpe_codec.codec(tokens.vocabulary())[0].decode(ids) == t


def test_decode_of_batches(spark, library):
    path = tokens.vocabulary()
    own = bpe_codec.BytePairCodec(path)
    lists = [own.encode("naïve Straße, 東京 🙂\n"), [], None, own.encode("🙂")[:1], own.encode("é")[-1:] * 3, [0, 2, 50256]]
    df = spark.createDataFrame(list(enumerate(lists)), "k int, ids array<int>").coalesce(1)
    got = {r["k"]: r["decoded"] for r in bpe_codec.decode(df, path).collect()}
    assert got == {k: None if x is None else library.decode(x, skip_special_tokens=False) for k, x in enumerate(lists)}
    assert own.decode_many(bpe_codec.pa.array([[], None], bpe_codec.pa.list_(bpe_codec.pa.int32()))) == ["", None]


def test_a_codec_query_holds_one_worker_a_task_and_few_chunks(spark, corpus):
    plan = queries.QUERIES["op9_bpe_codec"](spark, corpus)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    encoder = tokens.ChunkEncoder(lambda parts: [p.encode() for p in parts], [], limit=100)
    for i in range(100):
        assert encoder([f"{i} often {i}x{i} {i}y"]) == [f"{i} often {i}x{i} {i}y".encode()]
        assert i == 0 or any("often" in held for held in encoder._inner)
    assert sum(map(len, encoder._inner)) <= 100
    assert bpe_codec.codec(tokens.vocabulary())[1]._limit < 1_000_000


def test_frequent_pre_tokens_are_merged_once():
    own, merged = bpe_codec.BytePairCodec(tokens.vocabulary()), []
    plain = own._merge
    own._merge = lambda raw: merged.append(raw) or plain(raw)
    assert own.encode("andthose.\nWhere andthose, andthose!") == [i for w in ["andthose", ".", "\n", "Where", " andthose", ",", " andthose", "!"]
                                                                 for i in plain(w.encode())]
    assert len(merged) == len(set(merged)) == 7


def test_url_rules(spark, corpus):
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows(spark, "op10_url_rules", corpus)}
    assert [got[i] for i in range(9)] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("a.net", "", None, "allow"), ("a.net", "/x", "net/", "block"),
        ("www.example.net", "/en/1", "example.net/en/", "allow"), ("example.com", "/de/", "example.com/de/", "block"),
        ("b.org", "/fr/a", "org/fr/", "allow"), ("badnet", "/en/", None, "allow"), ("notexample.com", "/de/", None, "allow")]


def test_mined_rules_match_by_index(spark):
    from pyspark.sql import functions as F

    from tidemark.llm import url_rules

    data = spark.range(400).selectExpr("array('a', IF(id % 4 = 0, 'spam', 'fine'), concat('x', id % 7)) AS items", "id % 4 = 0 AS bad",
                                       "concat('u', id) AS url")
    rules = url_rules.mine(data)
    assert [r["rule_items"] for r in rules.collect()] == [["spam"]]
    hit = url_rules.matched(data.select("url", "items"), rules)
    assert hit.count() == 100 and hit.where(F.col("confidence") < 1).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_parts_catch_every_link(percent):
    """Sets that link share a token, at all sizes."""
    dice = np.random.default_rng(percent)
    for n in (1, 2, 3, 5, 6, 7, 12, 40, 41, 90, 300):
        for _ in range(20):
            s = np.unique(dice.integers(1, 1 << 62, n).astype(np.uint64))
            drop = dice.integers(0, len(s) // 6 + 1)
            t = np.unique(np.concatenate([s[drop:], dice.integers(1, 1 << 62, dice.integers(0, n // 10 + 1)).astype(np.uint64)]))
            both = len(np.intersect1d(s, t))
            if both and 100 * both >= percent * len(np.union1d(s, t)):
                assert len(np.intersect1d(jaccard.tokens(s, percent), jaccard.tokens(t, percent)))


def test_pipeline(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    kept, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, corpus)
        assert kept.columns == columns
        if name == "near_duplicates":
            assert sorted(r["doc_id"] for r in kept.collect()) == [4, 7, 8, 9, 10, 17]  # 16 is a near copy of 9
    left = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert set(left) == {4, 7, 8, 10, 17} and len(left[8].split()) == 170  # 9 was all passage
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, corpus).collect()} == set(left)


def test_pipeline_on_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


def plain_components(docs, n, percent):
    """component_id of every row, with every two sets compared."""
    sets = [set(zip(*[w[i:] for i in range(min(n, len(w)))])) if w else set() for w in (SPLIT.findall((t or "").lower()) for _, t in docs)]
    up = list(range(len(docs)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, t, least.get(find(i))) for i, (doc, t) in enumerate(docs) if doc is not None)


def crowded(rng, size=260):
    """One large family of near copies, families around it, and one passage in very many texts."""
    words = [f"w{i}" for i in range(900)]
    passage, base = rng.choices(words, k=60), rng.choices(words, k=120)
    docs = []
    for i in range(size):
        t = list(base) if i % 3 == 0 else rng.choices(words, k=70) + passage if i % 3 == 1 else docs[rng.randrange(len(docs))][1].split()
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = rng.choice(words)
        docs.append((i, " ".join(t)))
    return docs


@pytest.mark.parametrize("block", [5, 40, 2000])
def test_crowded_groups_keep_every_link(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    docs = crowded(random.Random(5))
    got = jaccard.components(spark.createDataFrame(docs, "doc_id long, text string"))
    texts = dict(docs)
    assert sorted((r["doc_id"], texts[r["doc_id"]], r["component_id"]) for r in got.collect()) == plain_components(docs, 4, 85)


@pytest.mark.parametrize("percent", [40, 80, 85])
def test_sketches_lose_no_link(percent):
    """Every set with a link to another component stays, whatever the sizes; sets with a passage in common go."""
    dice = np.random.default_rng(percent)
    sets, component = [], []
    for n in (1, 2, 9, 31, 33, 100, 255, 257, 700):
        base = np.unique(dice.integers(1, 1 << 62, n).astype(np.uint64))
        for cut in (0, n // 12, n // 6, n // 2, n - n // 5):
            sets.append(np.unique(np.concatenate([base[cut:], dice.integers(1, 1 << 62, cut // 2).astype(np.uint64)])))
            component.append(len(sets) // 2)
    component = np.asarray(component)
    for side in (None, np.arange(len(sets)) % 3 == 0):
        near = jaccard.partnered(np.asarray([len(s) for s in sets]), component, [jaccard.sketch(s) for s in sets], percent, side)
        for i, s in enumerate(sets):
            for j, t in enumerate(sets[:i]):
                both = len(np.intersect1d(s, t))
                if component[i] != component[j] and (side is None or side[i] != side[j]):
                    assert 100 * both < percent * (len(s) + len(t) - both) or near[i] and near[j]
    passage = dice.integers(1, 1 << 62, 150).astype(np.uint64)
    sets = [np.unique(np.concatenate([passage, dice.integers(1, 1 << 62, 150).astype(np.uint64)])) for _ in range(50)]
    if percent >= 80:
        assert not jaccard.partnered(np.full(50, 300), np.arange(50), [jaccard.sketch(s) for s in sets], percent).any()


def test_two_texts_under_one_id_and_null_ids(spark):
    rng = random.Random(3)
    a, b, c = (" ".join(rng.choices([f"w{i}" for i in range(500)], k=100)) for _ in range(3))
    docs = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (None, b + " z"), (None, c), (4, c + " z"), (5, None), (5, " "), (1, a)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {"kept_text": F.lit(1), "nd_th": F.lit(2), "rp_kept": F.lit(3), "pii_": F.lit(4)})
    got = jaccard.components(df)
    named = {(r["doc_id"], r["th"]): r["component_id"] for r in got.collect()}
    want = {(d, t): k for d, t, k in [(1, a, 1), (1, b, 1), (2, a + " x", 1), (3, b + " y", 1), (None, c, 4), (None, b + " z", 1),
                                      (4, c + " z", 4), (5, None, 5), (5, " ", 5)]}
    hashed = {(r["doc_id"], r["text"]): r["th"] for r in df.select("doc_id", "text", F.xxhash64("text").alias("th")).collect()}
    assert named == {(d, hashed[d, t]): k for (d, t), k in want.items()}
    kept = corpus_pipeline.near_duplicates(spark, df, "")
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(
        [(1, a), (1, b), (None, b + " z"), (None, c), (4, c + " z"), (5, None), (5, " ")], key=repr)
    assert corpus_pipeline.repeated_passages(spark, df, "").columns == df.columns
