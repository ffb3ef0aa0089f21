"""The llm operators against brute force, on rows with nulls, ties, copies, long texts and clashing columns."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from llm import language, merge_replay, near_text, packing, passages, quality, suffixes, token_files, url_rules, vectors
from llm.common import keep_rows
from llm.queries import URL_RULES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, th string, spots string, node int, kept string, n_words string"


def _words(rng, n):
    return [rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.3 else "".join(rng.choices("abcdefg", k=rng.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    passage = " ".join(_words(rng, 90))
    base = _words(rng, 200)
    near = [*base[:50], "changed", *base[51:]]
    texts = {
        1: None, 2: "", 3: " \t\n ", 4: "x" * 30_000, 5: " ".join(_words(rng, 8000)), 6: " ".join(base), 7: " ".join(near), 8: " ".join(base),
        9: passage, 10: " ".join(_words(rng, 40)) + "\n" + passage + " tail", 11: passage + passage, 12: "ab " * 400, 13: "one two three",
        14: "one two three", 15: " ".join(reversed(base)), 16: "é ü   wide  spaces\n\n x", 17: "aaaa " * 3 + "#*$%&|<>",
    }
    out = [(k, t, "en" if k % 2 else None, None if k % 3 else "s", 1) for k, t in texts.items()]
    out += [(None, "a row without an id", "en", "s", None), (6, texts[6], "en", "s", 1)]
    return [(*r, "clash", "clash", "clash", 1, "clash", "clash") for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_byte_repeats(spark, rows, docs):
    texts = {(r[0], r[1] or "") for r in rows}
    seen = Counter(t.encode()[i : i + 400] for _, t in texts for i in range(len(t.encode()) - 399))
    want = Counter()
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 399):
            if seen[data[i : i + 400]] > 1:
                gone[i : i + 400] = True
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        want[(doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    assert Counter(map(tuple, suffixes.remove_repeats(docs).collect())) == want
    assert suffixes.remove_repeats(_empty(spark)).count() == 0


def test_passage_repeats(spark, rows, docs):
    want, seen = {}, set()
    for doc_id, text in sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is not None, r)):
        words = WORD.findall(text)
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            run = tuple(words[i : i + 20])
            if run in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(run)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        want[doc_id] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    found = passages.remove_repeats(docs).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == want
    assert passages.remove_repeats(_empty(spark)).count() == 0


def _best_fit(lengths, capacity):
    """Sequences that best-fit-decreasing needs."""
    gaps: list[int] = []
    for n in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= n]
        if fitting:
            gaps.remove(min(fitting))
        gaps.append((min(fitting) if fitting else capacity) - n)
    return len(gaps)


def test_packing(spark, rows, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(packing.cut(docs, path, 256, 0), 256).collect()
    assert sum(r["piece"] == 0 for r in pieces) == len(rows)
    assert all(0 < r["length"] <= 256 and (r["piece"] == 0 or r["length"] == 256) for r in pieces)
    by_sequence: dict = {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == by_sequence.get(r["sequence_id"], 0)
        by_sequence[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(by_sequence.values()) <= 256
    assert len(by_sequence) == _best_fit([r["length"] for r in pieces], 256)
    assert packing.pack(packing.cut(_empty(spark), path, 256, 0), 256).count() == 0


def test_best_fit_is_best_fit_decreasing():
    rng = random.Random(5)
    lengths = [rng.choice([1, 2, 3, 7, 20, 33, 50, 64]) for _ in range(500)]
    runs = packing.best_fit(dict(Counter(lengths)), 64)
    assert sum(runs["n"]) == 500
    assert max(r["sequence"] + r["n"] // r["each"] for r in runs) == _best_fit(lengths, 64)


def test_token_files_round_trip(spark, rows, docs, tmp_path):
    from tokenizers import Tokenizer

    path, folder = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "shards")
    index = token_files.write(docs, folder, path, 1, 64)
    index = spark.createDataFrame(index.collect(), token_files.INDEX)
    found = sorted(token_files.read(index, folder).collect(), key=lambda r: r["start"])
    tokenizer, start = Tokenizer.from_file(path), 0
    for row, (doc_id, text) in zip(found, sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r)), strict=True):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert tuple(row) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    shard = index.first()
    ids, mask = token_files.ShardReader(folder, shard["path"]).sequence(0)
    assert len(ids) == len(mask) == 64
    assert token_files.write(_empty(spark), folder, path, 1).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunk_encoder(spark, folder, name):
    from tokenizers import Tokenizer

    from llm import chunks

    texts = [r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    texts += ["It's WE'LL don't  x\n\n y", "İstanbul Éa e\u0301 ſ ß ǅ", "a<|endoftext|>b <|startoftext|>", "x\x00\x7f\xa0y ½ ²3", "日本 語 😀a", "12345 a1b2 _x_ ''s"]
    encoder, tokenizer = chunks.file_encoder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_encoded_once(name):
    from tokenizers import Tokenizer

    from llm import chunks

    path = public_tokenizers.path(name)
    encoder, tokenizer, given = chunks.file_encoder(path), Tokenizer.from_file(path), []
    encoder.forget()
    encode_words = encoder.words.encode_new
    encoder.words.encode_new = lambda words: given.append(words) or encode_words(words)
    try:
        texts = ["Thonre anly sttible", "Thonre, anly. sttible; 'anly' anly's", "", " a  b\n\nthonre!? (anly) \t sttible_ 1anly2 Ā ĀĀ ª ﬁ İx Ⱥx Ǆa", "x\0y Ā\0"]
        for text in texts + texts:
            assert encoder.encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    finally:
        encoder.words.encode_new = encode_words
    words = [word for some in given for word in some]
    assert len(given) > 1 and len(words) == len(set(words))
    encoder.forget()
    assert not encoder.words.known and not encoder.chunks.known


def test_merge_replay(spark, rows, docs):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = np.array(encoding.encode_ordinary(text or ""), "<u4")
        want[(doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())] += 1
    assert Counter(map(tuple, merge_replay.encode_decode(docs, path, public_tokenizers.PATTERN).collect())) == want
    own = merge_replay.MergeRanks(path)
    for word in ("x" * 5000, "abcabcabc" * 40, " thérntion"):
        assert own.one_word(word.encode()) == encoding._encode_single_piece(word)
    assert merge_replay.encode_decode(_empty(spark), path, public_tokenizers.PATTERN).count() == 0


def test_quality_statistics(spark, rows, docs):
    want = Counter()
    for doc_id, text, *_ in rows:
        words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        times, covered = Counter(runs), set()
        for i, run in enumerate(runs):
            if times[run] > 1:
                covered.update(range(i, i + 5))
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        want[(doc_id, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed)] += 1
    found = quality.judge(docs)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(map(tuple, found.select(names).collect())) == want
    assert found.where("kept and base_failed").count() == 0
    assert quality.judge(_empty(spark)).count() == 0


def test_quality_outliers(spark):
    rng = random.Random(9)
    rows = [(k, " ".join(_words(rng, rng.randint(60, 300))), "en", "s" if k % 3 else "hot") for k in range(900)]
    rows += [(k, " ".join(w + "###" for w in _words(rng, 100)), "en", "hot") for k in range(900, 910)]
    found = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert sorted(k for k, kept in found.items() if not kept) == list(range(900, 910))


def test_near_duplicates(spark, rows, docs):
    found = {r["doc_id"]: r["class_id"] for r in near_text.near_duplicates(docs).collect()}
    texts = {r[0]: near_text.labels(r[1] or "") for r in rows}
    for a, x in texts.items():
        for b, y in texts.items():
            if near_text.similarity(x, y) >= near_text.THRESHOLD:
                assert found[a] == found[b]
    assert found[7] == found[8] == found[6] == 6
    assert found[1] == found[2] == 1 and found[3] == 3
    assert found[13] == found[14] == 13 and found[15] == 15 and found[9] == 9
    assert near_text.near_duplicates(_empty(spark)).count() == 0


def _aligned_share(a, b):
    """(aligned, all) labelled shingles of two word lists, by dynamic programming."""
    shingles = []
    for words in (a, b):
        seen: Counter = Counter()
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        shingles.append([(run, seen.update([run]) or seen[run]) for run in runs])
    x, y = shingles
    row = [0] * (len(y) + 1)
    for s in x:
        before, row = row, [0]
        for k, t in enumerate(y):
            row.append(before[k] + 1 if s == t else max(before[k + 1], row[k]))
    return row[-1], len(x) + len(y) - row[-1]


def test_similarity_at_the_threshold():
    rng, at = random.Random(7), 0
    for union in [*range(5, 100, 5), 250, 400]:
        whole = [f"w{rng.randrange(10**9)}" for _ in range(union + 4)]
        part, gone = union * 4 // 5 + 4, union // 5
        for other in (whole[:part], whole[-part:], whole[gone // 2 :][:part], whole[: part - 1], whole[-part + 1 :], [*whole[gone:], "new"]):
            aligned, every = _aligned_share(whole, other)
            at += 5 * aligned == 4 * every
            a, b = near_text.labels(" ".join(whole)), near_text.labels(" ".join(other))
            for x, y in ((a, b), (b, a)):
                assert (near_text.similarity(x, y) >= near_text.THRESHOLD) == (5 * aligned >= 4 * every)
    assert at >= 60


def test_near_duplicates_at_the_threshold(spark):
    rng, rows = random.Random(8), []
    for k, union in enumerate([250, 300, 400, 600]):
        whole = [f"w{rng.randrange(10**9)}" for _ in range(union + 4)]
        rows += [(10 * k, " ".join(whole)), (10 * k + 1, " ".join(whole[: union * 4 // 5 + 4])), (10 * k + 2, " ".join(whole[-(union * 4 // 5 + 4) :]))]
    found = {r["doc_id"]: r["class_id"] for r in near_text.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: i // 10 * 10 for i, _ in rows}


def test_near_duplicates_compare_few_pairs_of_one_template(spark, monkeypatch):
    """Copies of a template, unlike each other, whose changes are each in two copies: every shingle is shared, few pairs share a rare one."""
    rng, asked = random.Random(12), []
    template = [f"t{rng.randrange(10**9)}" for _ in range(400)]
    copies = [list(template) for _ in range(100)]
    for _ in range(12):
        dealt = rng.sample(range(100), 100)
        for x, y in zip(dealt[::2], dealt[1::2], strict=True):
            at = rng.choice([p for p in range(3, 397, 6) if copies[x][p] == copies[y][p] == template[p]])
            copies[x][at] = copies[y][at] = f"c{rng.randrange(10**9)}"
    copies += [[*c[:200], "other", *c[201:]] for c in copies[:30]]
    texts = [" ".join(c) for c in copies]
    plain = near_text.verified

    def verified(pairs, known):
        asked.append(pairs.count())
        return plain(pairs, known)

    monkeypatch.setattr(near_text, "verified", verified)
    found = near_text.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["doc_id"]: r["class_id"] for r in found.collect()} == {k: k % 100 for k in range(130)}
    marks = [near_text.labels(x) for x in texts]
    linked = {(x, y) for x in range(130) for y in range(x + 1, 130) if near_text.similarity(marks[x], marks[y]) >= near_text.THRESHOLD}
    assert linked == {(k, k + 100) for k in range(30)}
    assert sum(asked) < 2000  # of 8385


def test_language(spark, docs, folder):
    known = spark.read.parquet(f"{folder}/documents.parquet")
    model = language.fit(known.where(~language.held_out(F.col("doc_id"))))
    held = language.predict(known.where(language.held_out(F.col("doc_id"))), model)
    assert held.where("lang <> lang_pred").count() <= 0.02 * held.count()
    odd = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert all(odd[k]["lang_pred"] == "und" and odd[k]["score"] == 0 and odd[k]["rejected"] for k in (1, 2, 3))
    assert all(0 <= r["score"] <= 1 for r in odd.values())
    nothing = language.fit(_empty(spark))
    assert {r["lang_pred"] for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(_empty(spark), model).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 16))
    x[100:160] = x[:60] + rng.normal(size=(60, 16)) * 0.15
    x[200:230] = x[0]
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, [None] * 16, 1), (404, [], 1), (None, x[0].tolist(), 1), (405, [float("inf")] * 16, 1)]
    schema = "vec_id long, embedding array<double>, rep int"
    found = {r["vec_id"]: r for r in vectors.near_duplicates(spark.createDataFrame(rows, schema)).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    counts = close.sum(1) - 1
    got = np.array([found[k]["n_links"] for k in range(400)])
    assert (got <= counts).all() and got.sum() >= 0.9 * counts.sum()
    assert all(found[k]["n_links"] == 0 and found[k]["kept"] for k in (400, 401, 402, 403, 404, 405, None))
    assert found[210]["component_id"] == 0 and not found[210]["kept"]
    assert vectors.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_vectors_of_many_lists(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 64))
    x[1500:] = x[:1500] + rng.normal(size=(1500, 64)) * 0.45
    x[2000:2600] = x[5] + rng.normal(size=(600, 64)) * 0.2  # one group over far more than 16 lists
    x[2900:2950] = x[5]
    settings = vectors.IndexSettings(list_size=8, block=256)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in vectors.near_duplicates(table, settings=settings).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    component = np.arange(len(x))
    while (lower := np.array([component[row].min() for row in close])).tolist() != component.tolist():
        component = lower
    assert [found[k]["n_links"] for k in range(len(x))] == (close.sum(1) - 1).tolist()
    assert [found[k]["component_id"] for k in range(len(x))] == component.tolist()


def test_vectors_are_not_shuffled_to_those_they_meet(spark, monkeypatch):
    """Whatever the number of zones, shuffles hold a vector about once; zones may be dealt to several tasks."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 64)).astype(np.float32)
    x[1000:] = x[:1000] + rng.normal(size=(1000, 64)).astype(np.float32) * 0.45
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    seen, disk = [], spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        seen.append(sum(f.length() for f in map(files.apply, range(files.size())) if f.getName().startswith("shuffle_")))

    shuffled()
    monkeypatch.setattr("llm.common.gc.collect", shuffled)  # a table is written, its shuffles are still there
    found = {r["vec_id"]: r for r in vectors.near_duplicates(table, settings=vectors.IndexSettings(list_size=8, block=32)).collect()}
    assert max(seen) - seen[0] < 3 * x.nbytes
    dealt = vectors.near_duplicates(table, settings=vectors.IndexSettings(list_size=16, block=256, asking=512)).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    assert [found[k]["n_links"] for k in range(len(x))] == (close.sum(1) - 1).tolist()
    assert {r["vec_id"]: r for r in dealt} == found


def test_vectors_of_one_hash(spark, monkeypatch):
    """Vectors whose hashes are equal are still told apart, also where their zone is dealt to several tasks."""
    x = np.random.default_rng(4).normal(size=(300, 8))
    x[100:140], x[200:220] = x[:40] * 1.001, x[:20]
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    settings = vectors.IndexSettings(list_size=8, block=16, slot=8, asking=32)
    plain = {r["vec_id"]: r for r in vectors.near_duplicates(table, settings=settings).collect()}
    monkeypatch.setattr(vectors.F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    assert {r["vec_id"]: r for r in vectors.near_duplicates(table, settings=settings).collect()} == plain
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert [plain[k]["n_links"] for k in range(len(x))] == ((unit @ unit.T >= 0.9).sum(1) - 1).tolist()


def test_url_rules(spark):
    urls = {
        1: "http://A.Example.ORG/es/1", 2: "https://example.org/en/12?x", 3: "http://x.org#f", 4: "http://y.com/de/1", 5: "http://com/fr/", 6: None,
        7: "no scheme", 8: "http://myexample.org/es/", 9: "", 10: "http://notcom/de/", **{k: f"http://spam{k}.net/buy/{k}" for k in range(20, 60)},
    }
    pages = spark.createDataFrame([(k, u, "x", "x") for k, u in urls.items()], "page_id long, url string, host string, verdict string")
    labels = spark.createDataFrame([(k, 0, 1) for k in range(20, 50)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    found = {r["page_id"]: tuple(r)[1:] for r in url_rules.judge(pages, labels, URL_RULES).collect()}
    assert found[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert found[2][2:] == ("example.org/en/1", "block") and found[3][:3] == ("x.org", "", None)
    assert found[4][2:] == ("com/de/", "block") and found[5][2:] == ("com/fr/", "allow")
    assert found[6] == found[9] == ("", "", None, "allow") and found[7][:3] == ("", "", None)
    assert found[8][2:] == ("org/", "allow") and found[10][2] is None
    assert all(found[k][3] == "block" for k in range(50, 60))  # mined from labels of other pages
    assert url_rules.judge(pages.limit(0), labels, URL_RULES).count() == 0
    assert url_rules.judge(pages, labels.limit(0), URL_RULES).count() == len(urls)


def test_clashing_names(spark, docs):
    named = docs.select("doc_id", "text", "lang", *[F.lit(c).alias(c) for c in ("_text", "__text", "_id", "_key", "a.b")])
    model = language.fit(docs.withColumn("lang", F.lit("en")))
    plain = {tuple(r) for r in language.predict(docs.select("doc_id", "text"), model).collect()}
    judged = language.predict(named, model, with_text=True)
    assert judged.columns == ["doc_id", "lang", "_text", "__text", "_id", "_key", "a.b", "text", "lang_pred", "score", "rejected"]
    found = judged.collect()
    assert {(r["doc_id"], r["lang_pred"], r["score"], r["rejected"]) for r in found} == plain
    assert all(r["a.b"] == "a.b" and r["__text"] == "__text" for r in found)
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    decisions = near_text.near_duplicates(docs)
    kept = keep_rows(named, decisions)
    assert kept.columns == named.columns
    assert kept.count() == keep_rows(docs.select("doc_id", "text"), decisions).count()


def test_pipeline_stages(spark, docs, folder):
    import corpus_pipeline

    documents = docs.select(*corpus_pipeline.COLUMNS, "th", *[F.lit(7).alias(c) for c in ("_id", "_KEY", "__key", "_text", "judged")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, folder).columns == list(corpus_pipeline.COLUMNS)
        assert stage(spark, documents.limit(0), folder).count() == 0
    kept = corpus_pipeline.STAGES[2][1](spark, documents, folder)
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] in (6, 7, 8)) == [6, 6]
    assert corpus_pipeline.run(spark, folder).count() > 0
