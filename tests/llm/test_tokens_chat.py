import base64
import hashlib
import random
import time

import public_tokenizers
import pytest

from pelagic.llm.chat import ChatFormatter, chat_digests, format_chats
from pelagic.llm.token_counts import PieceVocabulary, TokenCounter, token_counts

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "\n", " " * 100, "a" * 3000, "ab" * 500, "\n\n ", "▁▁x", "<s> </s> <0x0A> <unk>", "\u0000\r\t", "ﬁ\U0001f600中"] + [" " * k + "b" for k in range(40)]


def test_counts_equal_the_librarys():
    import sentencepiece

    r = random.Random(4)
    parts = ["a", "b", "the", " ", "  ", "\n", "\t", "é", "中", "\U0001f600", "ing", "tion", "▁", "<s>", "aaa", " " * 20]
    texts = ODD + ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(500)]
    want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(texts)]
    vocabulary = PieceVocabulary.load(PIECES)
    assert TokenCounter(vocabulary).counts(texts) == want
    small = TokenCounter(vocabulary, entries=50)
    assert [small.counts([t])[0] for t in texts] == want


def test_long_words_equal_the_librarys():
    """Unbroken texts of a megabyte in seconds, and both ways of merging on words of every length."""
    import sentencepiece

    r = random.Random(8)
    library, vocabulary = sentencepiece.SentencePieceProcessor(model_file=PIECES), PieceVocabulary.load(PIECES)
    texts = ["".join(r.choice("aeiounrstl") for _ in range(n)) for n in (127, 128, 129, 1000, 60_000)]
    texts += [base64.b64encode(r.randbytes(750_000)).decode(), "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(300_000)), "  " + "the" * 400 + "\n" + "ing" * 300 + " x", "\n" * 300 + "=" * 4000, "a" * 200 + " " * 200 + "b" * 200]
    counter = TokenCounter(vocabulary)
    began = time.monotonic()
    assert counter.counts(texts) == [len(x) for x in library.encode(texts)]
    assert time.monotonic() - began < 60 and max(map(len, counter.seen)) <= 128
    words = ["▁" + "".join(r.choice("abthein g中é<").replace(" ", "") for _ in range(r.randint(1, 120))) for _ in range(400)]
    tokens, lone = vocabulary.count(words)
    assert [vocabulary.count_long(w) for w in words] == list(zip(tokens.tolist(), lone.tolist()))


def test_merges_at_once_equal_one_by_one():
    pieces, scores = ["a", "b", "c", "▁", "ab", "aa", "abc", "▁a"], [-9, -9, -9, -9, -1, -2, -3, -4]
    vocabulary = PieceVocabulary(pieces, scores)
    words = ["▁aaab", "▁abcabc", "▁cab", "▁aaaa"]
    at_once = vocabulary.count(words)[0].tolist()
    vocabulary.at_once = False
    assert vocabulary.count(words)[0].tolist() == at_once


def test_token_counts_of_odd_rows(odd, empty):
    got = {r["doc_id"]: r for r in token_counts(odd, PIECES, limit=3).collect()}
    assert token_counts(odd, PIECES).count() == odd.count() and token_counts(empty, PIECES).count() == 0
    assert (got[1]["n_tokens"], got[1]["n_bytes"], got[1]["over_limit"]) == (0, 0, False) and got[8]["over_limit"]


@pytest.fixture(scope="module")
def formatter():
    return ChatFormatter(BYTES)


def test_chat_round_trip(formatter):
    r = random.Random(2)
    parts = ["a", "<|im_end|>", "\n", "<\\|", "<|", "\\", "|", "<", "é", "\U0001f600", " ", "  ", "<|im_start|>assistant", "ok", "\\n", "<|endoftext|>"]
    for _ in range(1500):
        turns = [(r.choice(["user", "assistant", "assistant", "s<|x", "a\\n\nb", ""]), "".join(r.choice(parts) for _ in range(r.randint(0, 7)))) for _ in range(r.randint(1, 6))]
        made = formatter.format(turns)
        assert made.turns() == turns and made.loss_text() == "".join(t for role, t in turns if role == "assistant")


def test_chats_of_odd_rows(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "hi"), (2, 0, None, ""), (2, 0, None, ""), (None, 0, "assistant", "x"), (3, None, "assistant", "late"), (3, 0, "assistant", "y" * 30_000)]
    frame = spark.createDataFrame([(*x, 5) for x in rows], "conv_id long, turn long, role string, text string, n_turns int")
    got = {r["conv_id"]: r for r in chat_digests(frame, BYTES).collect()}
    assert {i: r["n_turns"] for i, r in got.items()} == {1: 2, 2: 2, 3: 2, None: 1}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\nhi\nassistant\n\n").hexdigest() and got[1]["loss_chars"] == 0
    assert got[3]["loss_sha256"] == hashlib.sha256(b"late" + b"y" * 30_000).hexdigest()
    assert chat_digests(frame.limit(0), BYTES).count() == 0
    assert format_chats(frame, BYTES).where("conv_id = 1").first()["formatted"].startswith("<|im_start|>user\nhi<|im_end|>\n")
