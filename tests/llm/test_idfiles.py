"""Token-id files: round trips, checksums, and rows against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from inkwell.llm import idcoder, idfiles
from tests.llm.helpers import documents
from tests.llm.test_bpe import texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("block", [1, 7, 63, 65, 300, 4096, 1 << 16])
@pytest.mark.parametrize("n", [1, 2, 5, 64, 129, 900, 4097, 40_001])
def test_round_trips(block, n):
    rng = np.random.default_rng(n)
    if block < 100:
        n = min(n, 900)
    for ids in (rng.integers(0, 50_257, n), np.minimum(rng.geometric(0.01, n), 50_256), np.zeros(n, int), np.arange(n) % 3, np.arange(n) * 40_000 % 2**31):
        blocks = idcoder.encode_blocks(ids, block)
        assert len(blocks) == -(-n // block)
        assert (idcoder.decode_blocks(blocks) == ids).all()


def test_blocks_stand_alone():
    ids = np.random.default_rng(0).integers(0, 500, 1000)
    blocks = idcoder.encode_blocks(ids, 100)
    assert (idcoder.decode_blocks(blocks[3:4]) == ids[300:400]).all()
    assert (idcoder.decode_blocks(blocks[::-1]) == ids.reshape(10, 100)[::-1].ravel()).all()
    assert len(idcoder.encode_blocks(np.empty(0, int))) == 0 == len(idcoder.decode_blocks([]))


def test_predictions_pay():
    ids = np.tile(np.random.default_rng(0).integers(0, 5000, 200), 40)
    assert sum(map(len, idcoder.encode_blocks(ids, 8000))) < 0.25 * 2 * len(ids)


def test_damage_is_found():
    ids = np.random.default_rng(0).integers(0, 500, 1000)
    for at in (-20, -200, 9):
        b = bytearray(idcoder.encode_blocks(ids)[0])
        b[at] ^= 4
        with pytest.raises((ValueError, IndexError, zlib.error)):
            idcoder.decode_blocks([bytes(b)])
    with pytest.raises(ValueError):
        idcoder.decode_blocks([b"none" + bytes(40)])


ODD = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> y " * 3, "", "a" * 5000, "it's 'sabc ''s 're've x'll'd  'm\n's \n 't", "a  b\n\n c \t d  ", " ", "  ", "\x85a\xa0b \x1c c\x1f", "²3¼ªº µß", "Ā latin no more's", "'s", "x'", "'", "don't'", "é's ", "\x00\x07 z"]


def flat(t, many, end=None):
    ids, n = t.encode_batch(many, end)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


def test_tokenizer_equals_the_library_as_loaded():
    library, t = Tokenizer.from_file(PATH), idfiles.Tokenizer(PATH)
    rng = np.random.default_rng(1)
    drawn = ["".join(np.array(list("ab 's'tre'll1.,\n\t'v \xe9\xa0\x85\xb2"))[rng.integers(0, 22, rng.integers(1, 40))]) for _ in range(3000)]
    for many in ([*texts(500), *ODD], drawn, [""], []):
        for s, ids in zip(many, flat(t, many) if many else [], strict=True):
            assert ids == library.encode(s, add_special_tokens=False).ids, s
    assert flat(t, ODD, 2) == [library.encode(s, add_special_tokens=False).ids + [2] for s in ODD]


def test_small_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(idfiles, "CACHE", 3)
    library, t = Tokenizer.from_file(PATH), idfiles.Tokenizer(PATH)
    for s in texts(50):
        assert flat(t, [s]) == [library.encode(s, add_special_tokens=False).ids]


class Counted:
    """A library whose model counts its calls."""

    def __init__(self, library):
        self.library, self.model, self.calls = library, self, 0

    def tokenize(self, text):
        self.calls += 1
        return self.library.model.tokenize(text)


def test_the_model_is_asked_for_many_words_at_once():
    library, t = Tokenizer.from_file(PATH), idfiles.Tokenizer(PATH)
    t.library = counted = Counted(t.library)
    words = ["".join(np.array(list("abcdeéßÿ"))[np.random.default_rng(k).integers(0, 8, 12)]) for k in range(2000)]
    expected = [library.encode(s, add_special_tokens=False).ids for s in (" ".join(words), "x " + " ".join(words[::-1]))]
    assert flat(t, [" ".join(words)]) == expected[:1]
    assert counted.calls <= 100
    assert flat(t, ["x " + " ".join(words[::-1])]) == expected[1:]
    assert counted.calls <= 110


def test_words_with_the_joint_and_models_without_one(monkeypatch):
    library, t = Tokenizer.from_file(PATH), idfiles.Tokenizer(PATH)
    joint = t.joint.decode()
    many = [joint, f"a{joint}b {joint}{joint} c", f"{joint} word " * 200, "plain words", "w" * 70 + f" {'é' * 11} {'é' * 12} {'x' * 22} {'x' * 23} {'x' * 24} {'x' * 300}"]
    expected = [library.encode(s, add_special_tokens=False).ids for s in many]
    assert flat(t, many) == expected == flat(t, many)
    alone = idfiles.Tokenizer(PATH)
    alone.joint = None
    assert flat(alone, many) == expected


def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(idfiles._Memory, "_hashed", staticmethod(lambda rows: rows[:, 0] % np.uint64(3)))
    library, t = Tokenizer.from_file(PATH), idfiles.Tokenizer(PATH)
    for s in [*texts(20), *texts(20)]:
        assert flat(t, [s]) == [library.encode(s, add_special_tokens=False).ids]


def test_pieces_of_a_long_text():
    library = Tokenizer.from_file(PATH)
    for s in ["It's a long text, with  numbers 12 and é marks...\nlines <|endoftext|> too " * 40, "nocut" * 50, "", "a b"]:
        cut = list(idfiles.pieces(s.encode(), 30))
        assert b"".join(cut) == s.encode()
        assert [i for p in cut for i in library.encode(p.decode(), add_special_tokens=False).ids] == library.encode(s, add_special_tokens=False).ids


@pytest.mark.parametrize(("segment", "piece"), [(1 << 22, 1 << 22), (40, 1 << 22), (3000, 200)])
def test_rows(spark, tmp_path, monkeypatch, segment, piece):
    monkeypatch.setattr(idfiles, "SEGMENT", segment)
    monkeypatch.setattr(idfiles, "PIECE", piece)
    rows = [(k * 7 % 400, t) for k, t in enumerate(texts(200))] + [(1000, None), (1001, ""), (1002, "word " * 50_000), (5, "b again"), (5, "a again"), (-3, "least"), (None, "no id"), *[(2000 + k, t) for k, t in enumerate(ODD)]]
    to = str(tmp_path / "ids")
    idfiles.write_ids(documents(spark, rows, ("part", "start")).repartition(3), PATH, to)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in idfiles.read_checks(spark, to).collect()), key=lambda r: r[1])
    library = Tokenizer.from_file(PATH)
    coded = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    least = lambda i: -(10**9) if i is None else i
    assert [g[0] for g in got] == sorted((i for i, _ in rows), key=least)
    assert [g[1] for g in got] == np.cumsum([0] + [g[2] for g in got])[:-1].tolist()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted(((g[0], g[2], g[3]) for g in got), key=str) == sorted(((i, len(x), crc(x)) for i, x in coded), key=str)


def test_no_rows(spark, tmp_path):
    idfiles.write_ids(documents(spark, []), PATH, str(tmp_path / "ids"))
    assert idfiles.read_checks(spark, str(tmp_path / "ids")).collect() == []
