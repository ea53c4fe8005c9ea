"""Special tokens in texts have the ids that the library's default gives them."""

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from topicloom.llm import records

PIECES = ["The", " ", ",", ".", "it's", "É", "é", "́", "日本", "\n", "<|", "|>", "<|ENDOFTEXT|>", "<|endoftext|>", "<|startoftext|>", "İ", "ŞEHRİ.", "H", "T", "J", "\u0331", "\u0308", "\u030c", "ﬀ", "ß", "ǅ", "Ω", "ſ", "K", "\u0307"]
TEXTS = [None, "", "<|endoftext|>", "One.<|startoftext|>Two <|EndOfText|>", "plain", "a <|endoftext|><|endoftext|> b", "ŞEHRİ. BELEDİYESİ, İ!", "H\u0331. T\u0308, J\u030c"]


def default():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=4))
def test_whole_texts_encode_like_the_default(texts):
    got = [np.frombuffer(x, "<u2").tolist() for x in records.encoder(records.tokenizer_path()).whole([t.encode() for t in texts])]
    assert got == [e.ids for e in default().encode_batch(texts, add_special_tokens=False)]


def test_records_of_special_tokens(spark):
    tokenizer, start, want = default(), 0, []
    for doc, text in enumerate(TEXTS):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    docs = spark.createDataFrame([*enumerate(TEXTS)], "doc_id long, text string")
    got = records.encoded(docs).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def test_every_letter_that_has_a_case():
    """Each letter whose case changes, alone and before punctuation or a mark."""
    letters = [c for c in map(chr, range(0x80, 0x1F000)) if c.lower() != c or c.upper() != c or c.isalpha() and ord(c) % 97 == 0]
    for ends in ("", ".", ",x", "\u0307.", "'s", "!?"):
        texts = [" ".join(c + ends for c in letters[k : k + 50]) for k in range(0, len(letters), 50)]
        got = [np.frombuffer(x, "<u2").tolist() for x in records.encoder(records.tokenizer_path()).whole([t.encode() for t in texts])]
        assert got == [e.ids for e in default().encode_batch(texts, add_special_tokens=False)], ends


def test_hot_ids_part(spark):
    """Repeated ids, null ids and repeated rows are dealt to several files; starts go on through them."""
    rows = [(None, f"text {k % 7}") for k in range(300)] + [(5, "same text") for _ in range(300)] + [(k, "x y") for k in range(6, 20)]
    got = records.encoded(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), file_bytes=2000).collect()
    assert sorted(map(repr, [r["doc_id"] for r in got])) == sorted(map(repr, [r[0] for r in rows]))
    for known in (None, 5):
        assert len({r["file"] for r in got if r["doc_id"] == known}) > 1
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order)
