"""Language ID: compressed sizes recomputed one text at a time, with a round trip of every block."""

import random

import pytest
import zstandard

from millrace.llm import language_id as li

WORDS = {"de": "der die das und nicht über straße haus wasser geht".split(),
         "en": "the and not over street house water goes with from".split(),
         "fr": "le la les pas sur rue maison eau va avec chez".split()}


def test_predictions_from_recomputed_sizes(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.choice([1, 5, 40, 3000]))), lang)
            for i, lang in enumerate(sorted(WORDS) * 20)]
    rows += [(900, None, "en"), (901, "", "de"), (902, "123 -- 456", "fr"), (903, "Haus the maison", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    contents = li.train_dictionaries(docs)
    assert sorted(contents) == sorted(WORDS)
    got = {r["doc"]["doc_id"]: r for r in li.predict_languages(docs, contents, block_bytes=4096).collect()}
    params = zstandard.ZstdCompressionParameters(**li.CODER)
    for ident, text, _ in rows:
        if not any(c.isalpha() for c in text or ""):
            assert (got[ident]["lang_pred"], got[ident]["score"], got[ident]["rejected"]) == ("und", 0.0, True)
            continue
        whole = li.letters(text).encode()
        while len(whole) < li.SHORT_BYTES:
            whole += li.letters(text).encode()
        sizes = {}
        for lang, body in contents.items():
            words = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            back, sizes[lang] = b"", 0
            for at in range(0, len(whole), 4096):
                packed = zstandard.ZstdCompressor(dict_data=words, compression_params=params).compress(whole[at:at + 4096])
                back += zstandard.ZstdDecompressor(dict_data=words).decompress(packed, max_output_size=8192)
                sizes[lang] += len(packed)
            assert back == whole
        best, second = sorted(sizes, key=lambda lang: (sizes[lang], lang))[:2]
        margin = (sizes[second] - sizes[best]) / sizes[second]
        assert got[ident]["lang_pred"] == best and got[ident]["margin"] == pytest.approx(margin)
        assert got[ident]["rejected"] == (margin < li.MARGIN)
    right = sum(got[i]["lang_pred"] == lang for i, _, lang in rows[:60])
    assert right >= 55


def test_nothing_to_judge(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert li.train_dictionaries(docs) == {} and li.predict_languages(docs, {}).count() == 0
