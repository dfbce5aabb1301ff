"""What a task process keeps from task to task."""

import gc
import weakref

import numpy as np

from tessera.llm import bpe, linear, token_file, toxicity
from tessera.llm.chunks import Memo


def _chain(bias):
    return toxicity.Chain(("toxic",), np.arange(0, 1 << linear.HASH_BITS, 3), np.ones((1, (1 << linear.HASH_BITS) // 3 + 1)),
                          np.zeros((1, 1)), np.array([bias]))


def test_a_process_keeps_one_memory_of_chunks():
    codec = bpe.codec(bpe.default_path())
    assert bpe.codec(bpe.default_path()) is codec
    ids, _ = codec.encode(["some words"])
    gone = weakref.ref(codec)
    del codec
    chain = toxicity._resident(_chain(0.5))
    assert toxicity._resident(_chain(0.5)) is chain
    gc.collect()
    assert gone() is None
    again, _ = bpe.codec(bpe.default_path()).encode(["some words"])
    assert again.tolist() == ids.tolist()


def test_a_full_memory_keeps_the_chunks_most_often_met():
    memo = Memo(lambda new: (np.array([int(c) for c in new], np.int32), np.ones(len(new), np.int64)))

    def take(numbers):
        rows = memo.rows([str(i) for i in numbers])
        memo.learn()
        assert memo.ids.take(rows)[0].tolist() == list(numbers)

    take([*range(60), *range(60)])
    take(range(60))
    take([*range(30), *range(100, 150)])
    memo.forget(100)
    assert len(memo) == 50 and set(memo) >= {str(i) for i in range(30)}
    take([*range(150), 7])


def test_new_chunks_are_searched_for_pieces_together(monkeypatch):
    e = token_file.Encoder(token_file.default_path())
    calls = []
    pattern = token_file.PIECES

    class Counted:
        def findall(self, text):
            calls.append(text)
            return pattern.findall(text)

    monkeypatch.setattr(token_file, "PIECES", Counted())
    texts = [f"Word{i}, it's {i} \nÄh!{i}  中{i} <|endoftext|>{i} \x85" for i in range(100)] + [None, "", " "]
    ids, n = e.encode(texts)
    assert len(calls) == 1
    want = [x.ids for x in e.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert np.split(ids, np.cumsum(n)[:-1])[0].tolist() == want[0] and ids.tolist() == [i for x in want for i in x]
