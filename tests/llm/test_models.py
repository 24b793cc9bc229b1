"""Language ID, quality neighbours and SentencePiece."""

import os
import random
import struct

import frames
import pytest
from pyspark.sql import functions as F

from tallygrid.llm import language_id, quality_neighbours, sentence_pieces
from tallygrid.llm.queries import MODEL

SAMPLES = {
    "en": "the house and the garden were quiet while she was reading that old book with them",
    "de": "das haus und der garten waren ruhig während sie dieses alte buch mit ihnen gelesen hat",
    "fr": "la maison et le jardin étaient calmes pendant que elle lisait ce vieux livre avec eux",
}


def sentences(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = list(SAMPLES)[i % 3]
        words = SAMPLES[lang].split()
        rows.append((" ".join(rng.choice(words) for _ in range(rng.randint(6, 30))), lang))
    return rows


def test_language_of_held_out_texts(spark):
    rows = sentences(240)
    docs = frames.documents(spark, [t for t, _ in rows], [x for _, x in rows]).repartition(4)
    out = language_id.split_and_predict(docs, F.col("doc_id") % 4 == 2).join(docs.select("doc_id", "lang"), "doc_id")
    held = out.where("held_out").collect()
    assert len(held) == 60 and sum(r["lang"] == r["lang_pred"] for r in held) >= 58
    assert all(0 <= r["score"] <= 1 for r in held)


def test_language_scores_match_plain_sums():
    import numpy as np

    texts = [t for t, _ in sentences(9)]
    counts = np.array([np.bincount(language_id.hashed([SAMPLES[x]])[0], minlength=language_id.BINS) for x in SAMPLES])
    model = language_id.Model(list(SAMPLES), counts, np.array([3, 2, 1]))
    best, _, _ = model.predict(texts)
    for text, lang in zip(texts, best, strict=True):
        sums = model.prior + model.logs[language_id.hashed([text])[0]].sum(0)
        assert lang == list(SAMPLES)[int(sums.argmax())]


def test_language_is_the_same_in_blocks_of_languages(spark):
    import numpy as np

    rows = sentences(120)
    docs = frames.documents(spark, [t for t, _ in rows] + ["12 3", None], [f"{x}{i % 3}" for i, (_, x) in enumerate(rows)] + ["en", "en"]).repartition(4)
    whole = {r["doc_id"]: r for r in language_id.predict(docs, language_id.learn(docs)).collect()}
    models = language_id.learn(docs, matrix_bytes=4 * language_id.BINS)
    assert len(models) == 4 and all(m.logs.shape == (language_id.BINS, 1) for m in models)
    split = {r["doc_id"]: r for r in language_id.predict(docs, models).collect()}
    assert {i: r["lang_pred"] for i, r in whole.items()} == {i: r["lang_pred"] for i, r in split.items()}
    assert all(whole[i]["score"] == pytest.approx(split[i]["score"], abs=1e-9) for i in whole)
    assert [split[i]["lang_pred"] for i in (120, 121)] == ["und", "und"]
    for i, (text, _) in enumerate(rows):  # against plain sums over all languages
        bins = language_id.hashed([text])[0]
        sums = {m.langs[0]: float(m.prior[0] + m.logs[bins, 0].sum(dtype=np.float64)) for m in models}
        best = min(sums, key=lambda k: (-sums[k], k))
        assert whole[i]["lang_pred"] == best and whole[i]["score"] == pytest.approx(1 / sum(np.exp(v - sums[best]) for v in sums.values()), abs=1e-6)


def test_language_of_long_texts_and_clashing_columns(spark):
    rows = sentences(60)
    docs = frames.documents(spark, [t for t, _ in rows] + ["ä" + " das haus und der garten" * 60_000], [x for _, x in rows] + ["de"]).withColumns({"lang_pred": F.lit("own"), "_out": F.lit("own")})
    got = language_id.predict(docs.unionByName(docs.where("doc_id = 60")), language_id.learn(docs)).where("doc_id = 60").collect()
    assert [r["lang_pred"] for r in got] == ["de", "de"] and all(0.99 < r["score"] <= 1 and r["n_words"] == "own" for r in got)


def test_language_on_odd_rows(spark):
    out = language_id.split_and_predict(frames.odd(spark), F.col("doc_id") == 4).collect()
    assert len(out) == 12
    assert {r["doc_id"]: r["lang_pred"] for r in out if r["doc_id"] in (0, 1, 2, 7)} == dict.fromkeys((0, 1, 2, 7), "und")
    assert language_id.split_and_predict(frames.odd(spark, empty=True), F.lit(False)).count() == 0
    nothing = language_id.predict(frames.odd(spark), language_id.learn(frames.odd(spark).where("false")))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


def test_quality_of_held_out_texts(spark):
    good = [f"{t}. {frames.PROSE} {i}" for i, (t, _) in enumerate(sentences(160))]
    bad = [" ".join(f"{w}###" for w in t.split()) for t, _ in sentences(40, 1)] + [" ".join(w for w in t.split() for _ in range(9)) for t, _ in sentences(40, 2)]
    docs = frames.documents(spark, good + bad).repartition(4)
    labels = frames.labels(spark, [(i, int(i < 160), 0) for i in range(240)])
    out = quality_neighbours.split_and_score(docs, labels, F.col("doc_id") % 5 == 0).where("held_out").collect()
    assert len(out) == 48 and sum((r["score"] >= 0.3) != (r["doc_id"] < 160) for r in out) <= 1


def test_neighbours_are_exact():
    import numpy as np

    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((500, 8)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = rng.integers(0, 2, 500).astype(float)
    axes = rng.standard_normal((quality_neighbours.WIDTH, 8)).astype(np.float32)
    model = quality_neighbours.Model(np.ones(quality_neighbours.WIDTH, np.float32), axes, vectors, labels, 0.5, 7, 4.0)
    block = [t.encode() for t, _ in sentences(20)]
    for own, score in zip(model.project(block), model.score(block), strict=True):
        near = vectors @ own
        top = np.argsort(-near)[:7]
        weight = np.maximum(near[top], 0).astype(float) ** 4
        assert score == pytest.approx(((weight * labels[top]).sum() + 1e-3 * 0.5) / (weight.sum() + 1e-3), abs=1e-5)


def test_quality_on_odd_rows(spark):
    labels = frames.labels(spark, [(4, 1, 0), (5, 1, 0), (7, 0, 0), (99, 1, 0), (None, 1, 0), (6, None, 0), (4, 1, 1)])
    out = quality_neighbours.split_and_score(frames.odd(spark), labels, F.col("doc_id") == 6).collect()
    assert len(out) == 12 and all(0 <= r["score"] <= 1 for r in out)
    none = quality_neighbours.split_and_score(frames.odd(spark), labels.where("false"), F.lit(False)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_neighbours.split_and_score(frames.odd(spark, empty=True), labels, F.lit(False)).count() == 0


needs_model = pytest.mark.skipif(not os.path.exists(MODEL), reason="no model file")
HARD = ["  a", "a  b", "  ", "a\n b\tc", "▁x y▁", "🎉é\u0301\x00", "-" * 50 + "a" * 70, "<s> </s> <unk> <0x41>", "x" * 5000, " lead", "trail ", *(t for t in frames.ODD if t)]


@needs_model
def test_pieces_agree_with_the_library(spark):
    import sentencepiece

    other = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = frames.documents(spark, HARD).repartition(3)
    coded = sentence_pieces.encode(docs, sentence_pieces.read_model(MODEL))
    rows = coded.collect()
    assert [r["text"] for r in rows if r["ids"] != other.encode(r["text"])] == []
    assert all(r["ids"] == other.encode(r["text"]) and r["n_tokens"] == len(r["ids"]) and r["parity"] for r in rows)
    back = {r["doc_id"]: r["text"] for r in sentence_pieces.decode(coded.drop("text"), sentence_pieces.read_model(MODEL)).collect()}
    assert all(back[r["doc_id"]] == other.decode(r["ids"]) for r in rows)
    assert all((back[r["doc_id"]] == r["text"]) == r["round_trip"] for r in rows)


@needs_model
def test_pieces_on_odd_rows(spark):
    out = sentence_pieces.encode(frames.odd(spark), sentence_pieces.read_model(MODEL)).collect()
    assert len(out) == 12
    by = {r["doc_id"]: r for r in out}
    assert by[0]["ids"] is None and by[0]["n_tokens"] == 0 and by[1]["ids"] == []
    assert sentence_pieces.encode(frames.odd(spark, empty=True), sentence_pieces.read_model(MODEL)).count() == 0


def field(number, value):
    """One protobuf field: int, float or bytes."""

    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_model(squeeze):
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    pieces += [(p, -1.0 - i * 0.37, 1) for i, p in enumerate(["▁the", "▁a", "▁", "the", "he", "t", "h", "e", "a", "b", "ab", "▁ab", "▁▁"])]
    data = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    trainer = field(3, 1) + field(35, 1) + field(40, 0) + field(41, 1) + field(42, 2)
    return data + field(2, trainer) + field(3, field(1, b"identity") + field(3, 1) + field(4, int(squeeze)) + field(5, 1))


@pytest.mark.parametrize("squeeze", [False, True])
def test_unigram_models_agree_with_the_library(squeeze):
    import sentencepiece

    data = unigram_model(squeeze)
    other = sentencepiece.SentencePieceProcessor(model_proto=data)
    coder = sentence_pieces.Codec(data)
    texts = ["the ab", "", "a  the  b", " theab ", "xyz the", "é ab 🎉"]
    for text, (ids, _, _) in zip(texts, coder.encode(texts), strict=True):
        assert list(struct.unpack(f"<{len(ids) // 4}i", ids)) == other.encode(text), text
    assert all(parity for _, parity, _ in coder.encode(texts))


def test_ids_are_the_backends_and_round_trips_are_per_text():
    texts = ["a b", "a  b", " a b", "a b", None, ""]
    for squeeze in (True, False):
        coder = sentence_pieces.Codec(unigram_model(squeeze))
        out = coder.encode(texts)
        for text, (ids, parity, back) in zip(texts, out, strict=True):
            own = coder.backend.encode(coder.cuts(text)[0], add_special_tokens=False).ids if text and not coder.model.by_cuts else None
            unpacked = list(struct.unpack(f"<{len(ids) // 4}i", ids))
            assert parity and own in (None, unpacked)
            assert back == (coder.decode([unpacked])[0] == (text or ""))
    assert [r[2] for r in sentence_pieces.Codec(unigram_model(True)).encode(texts)] == [True, False, False, True, True, True]


def test_memory_of_cuts_is_bounded_and_changes_nothing():
    data = unigram_model(False)
    texts = [f"the ab {i} x{i}" for i in range(300)]
    free, tight = sentence_pieces.Codec(data), sentence_pieces.Codec(data, remember=2000)
    assert [r for t in texts for r in tight.encode([t])] == free.encode(texts)
    assert tight.held < 4000 < free.held
    free.differ.add(free.cuts("the ab 299 x299")[0])
    assert not free.encode(["the ab 299 x299"])[0][1]  # a difference that was counted shows in parity
