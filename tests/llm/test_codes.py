"""Words beyond the broadcast table: coded where the text is read."""

import random

import pyarrow as pa

from playtrail.llm import sentencepiece_codes as codes


def test_rare_words_move_no_texts(spark):
    texts = ["a few words, and more words", "words " + "x" * 300, "日本 🙂 \x00é", "", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "doc_id long, text string")
    coded = codes.encode(docs, common=2)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan, plan
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_file=codes.MODEL)
    assert sorted((r.doc_id, list(r.codes)) for r in coded.collect()) == [(i, p.encode(t or "")) for i, t in enumerate(texts * 2)]


def test_array_lattice_equals_the_relational_one(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice(" abcé🙂") for _ in range(rng.randint(1, 12))) for _ in range(150)})
    rows = sorted({"".join(rng.choice("▁abc") for _ in range(rng.randint(1, 4))) for _ in range(60)} | {"é"})
    # Equal scores: ties go to the leftmost edge (BPE) and the longest last start (Viterbi).
    pieces = codes.Pieces.of([(s, 300 + i, -float(rng.randint(0, 5))) for i, s in enumerate(rows)])
    for model in ("bpe", "unigram"):
        marked = spark.createDataFrame([(w.replace(" ", codes.MARK), 1) for w in words], "word string, n long")
        want = {r.word.replace(codes.MARK, " "): list(r.codes) for r in codes.word_table(marked, pieces, model).collect()}
        got = codes.Lattice(pieces, model).table(pa.array(words))
        assert {w: got.codes[a:a + n].tolist() for w, a, n in zip(words, got.start, got.size)} == want, model


def test_a_long_run_has_the_codes_of_the_library():
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_file=codes.MODEL)
    got = codes.Lattice(codes.Pieces(), "bpe").table(pa.array([" " + "a" * 4000]))
    assert got.codes.tolist() == p.encode("a" * 4000)
