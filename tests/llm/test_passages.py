import random

import corpus_pipeline


def test_passages_of_over_fifty_words_go(spark, documents):
    """51 ordinary words are some 300 bytes; a shorter repeat stays."""
    draw = random.Random(3)
    words = lambda n: " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(n))
    passage, short = words(51), words(30)
    assert len(passage) < 400 and len(short) < corpus_pipeline.PASSAGE_BYTES
    around = [(words(20), words(20)) for _ in range(6)]
    rows = [(i, f"{a} {i}{(passage, passage, passage, short, short, words(60))[i]}{i} {b}") for i, (a, b) in enumerate(around)]
    found = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, documents(rows), "").collect()}
    for i, text in rows:
        assert found[i] == (text.replace(passage, "") if i < 3 else text)
