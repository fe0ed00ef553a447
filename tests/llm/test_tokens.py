"""Token counts and the merge automaton against the tokenizers library."""

import random
from hashlib import sha256

import numpy as np
import pytest
from surveyloom.llm import bpe_automaton, token_counts
from surveyloom.llm.word_vocabulary import WordVocabulary, default_path, read_vocabulary_file

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

ODD = [
    "", "  \n\t", "It's DON'T we'LL 's't're", "ÉÉ é ΣΑΣ İstanbul ǅ ﬁ ſs K Å",
    "a<|endoftext|>b <|startoftext|> <|endoftext|x", "12½ ²³ ⅷ ٣٤", "日本語 テスト 🎉🎉 👨‍👩‍👧",
    "a\x1cb\x1d c\x85d\xa0e f", "x" * 3000, "!!!???...", "\x00\x01 \x7f ab\x00c", "ȩ́́",
    "hahahahahahaha aaaaaaaaaaaaaaa", "the the the " * 2000,
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(default_path())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    letters = "abcdeéèñßüÄ'0123 \t\n!?#$<|>endoftext日Σσİ́"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    return ODD + made


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [*enumerate(texts), (None, None), (3, texts[3])]
    rows = [(i, t, "en", 1, "x") for i, t in rows]
    # Extra columns bear the names of results.
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, n_tokens int, ids string"
    )


def test_counts(docs, texts, library):
    found = token_counts.count_tokens(docs, limit=100).collect()
    assert len(found) == len(texts) + 2
    for row in found:
        text = texts[row.doc_id] if row.doc_id is not None else ""
        expected = len(library.encode(text, add_special_tokens=False).ids)
        assert (row.n_tokens, row.n_bytes) == (expected, len(text.encode())), text
        assert row.over_limit == (expected > 100)


def test_encoding_and_decoding(docs, texts, library):
    encoded = bpe_automaton.encode_texts(docs)
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    decoded = {r.doc_id: r.decoded for r in bpe_automaton.decode_ids(encoded).collect()}
    digests = {r.doc_id: r for r in bpe_automaton.encoding_digests(docs).collect()}
    for number, text in [*enumerate(texts), (None, "")]:
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids[number] == expected, text
        back = library.decode(expected, skip_special_tokens=False)
        assert decoded[number] == back
        packed = np.array(expected, "<u4").tobytes()
        assert digests[number].n_tokens == len(expected)
        assert digests[number].ids_sha256 == sha256(packed).hexdigest()
        assert digests[number].decoded_sha256 == sha256(back.encode()).hexdigest()


def test_automaton_of_a_small_vocabulary_accepts_what_merging_gives():
    import json

    content = json.loads(read_vocabulary_file())
    plain = [c for c in content["model"]["vocab"] if len(c.removesuffix("</w>")) == 1]
    merges = [["a", "b"], ["a", "a"], ["ab", "ab"], ["b", "a</w>"], ["aa", "ab"], ["b", "b"],
              ["ab", "a</w>"], ["bb", "bb"]]
    names = [*plain, *[a + b for a, b in merges]]
    content["model"] |= {"merges": merges, "vocab": {n: i for i, n in enumerate(names)}}
    content["added_tokens"] = [{"content": "<|endoftext|>", "id": len(names)}]
    text = json.dumps(content)
    vocab, machine = WordVocabulary(text), bpe_automaton.compile_automaton(text)
    encoder = bpe_automaton.Encoder(machine)
    rank = {tuple(m): i for i, m in enumerate(merges)}
    for length in range(1, 11):
        for bits in range(2**length):
            word = "".join("ab"[bits >> k & 1] for k in range(length))
            symbols = [*word[:-1], word[-1] + "</w>"]
            while pairs := [p for p in zip(symbols, symbols[1:]) if p in rank]:
                best, k, merged = min(pairs, key=rank.get), 0, []
                while k < len(symbols):
                    if tuple(symbols[k : k + 2]) == best:
                        merged.append("".join(best))
                        k += 2
                    else:
                        merged.append(symbols[k])
                        k += 1
                symbols = merged
            assert [vocab.labels[i] for i in encoder.piece(word)] == symbols, word


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        WordVocabulary(read_vocabulary_file(str(public_tokenizers.path("byte_bpe_50k.json"))))


def test_empty_table(docs):
    none = docs.where("false")
    assert token_counts.count_tokens(none).count() == 0
    assert bpe_automaton.encoding_digests(none).count() == 0


def test_pieces_of_every_code_point(library):
    """Each between letters and a digit, against the library's own normaliser and cut."""
    vocabulary = WordVocabulary(read_vocabulary_file())
    normal, cut = library.normalizer, library.pre_tokenizer
    wrong = []
    for point in range(1, 0x110000):
        if 0xD800 <= point < 0xE000:
            continue
        text = f"a{chr(point)}b1{chr(point)}"
        expected = [piece for piece, _ in cut.pre_tokenize_str(normal.normalize_str(text))]
        if [p for word in vocabulary.words(text) for p in vocabulary.pieces(word)] != expected:
            wrong.append(hex(point))
    assert wrong == []
