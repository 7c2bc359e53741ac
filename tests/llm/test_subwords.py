"""The transducer against the sentencepiece library."""

import random
import zlib

import numpy as np
import public_tokenizers
import sentencepiece

from tessella.llm.subwords import decode_pieces, encode_pieces, piece_round_trip, transducer

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_equal_the_library(docs):
    rnd = random.Random(11)
    alphabet = list("abcdefghijklmnopqrstuvwxyz    .,'-\n\t012éüñßжд漢字😀▁") + ["  ", "the", "ing", "<s>", "</s>", "<0x41>"]
    texts = [r["text"] for r in docs.limit(60).collect()]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 80))) for _ in range(3000)]
    texts += ["", " ", "x" * 700, *[" " * n + "a" + " " * n for n in (1, 2, 3, 15, 16, 17, 31, 40, 200)], *["▁" * n for n in range(1, 80)], *["a▁" + " " * n + "b ▁" for n in range(5)]]
    machine = transducer(PATH)
    for text, want in zip(texts, library().encode(texts, num_threads=1), strict=True):
        assert np.frombuffer(machine.encode(text), "<u4").tolist() == want, text


def test_long_texts_without_spaces_leave_nothing_behind():
    rnd, machine = random.Random(5), transducer(PATH)
    texts = ["".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(20_000)), "ab" * 20_000, " " * 30_000, "x" * 9_999]
    for text, want in zip(texts, library().encode(texts, num_threads=1), strict=True):
        assert np.frombuffer(machine.encode(text), "<u4").tolist() == want
    assert all(len(p) <= 64 for p in machine.known.rows) and machine.known.n_flat < 1_000_000


def test_a_bar_is_infinite_where_a_merge_crosses_it():
    machine = transducer(PATH)
    assert machine.neighbours("t", "h") == np.inf and machine.neighbours("▁th", "e") == np.inf
    path = machine.shortest_path("▁something")
    assert all(machine.neighbours(a, b) < np.inf for a, b in zip(path, path[1:], strict=False)) and "".join(path) == "▁something"


def test_decoding_equals_the_library(docs):
    texts = [r["text"] for r in docs.limit(60).collect()] + ["é漢😀 x", "  two", "a▁b"]
    sp, machine = library(), transducer(PATH)
    for t in texts:
        assert machine.decode(machine.encode(t)) == sp.decode(sp.encode(t))
    # bytes that are no text, and control ids
    ids = [3 + 0xE9, 1, 3 + 0x41, 2, 300]
    assert machine.decode(np.array(ids, "<u4").tobytes()).replace("�", "?") == sp.decode(ids).replace("�", "?").replace(" ⁇ ", "")


def test_query(docs, odd, none):
    for table in (docs, odd):
        rows = sorted(map(str, ((r["doc_id"], r["n_pieces"], r["ids_crc32"], r["decoded_equal"]) for r in piece_round_trip(table).collect())))
        texts = [(r["doc_id"], r["text"] or "") for r in table.collect()]
        ids = library().encode([t for _, t in texts], num_threads=1)
        assert rows == sorted(map(str, ((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes()), True) for (d, _), i in zip(texts, ids, strict=True))))
        back = sorted((str(r["doc_id"]), r["text"]) for r in decode_pieces(encode_pieces(table)).collect())
        assert back == sorted((str(d), t) for d, t in texts)
    assert piece_round_trip(none).collect() == []
