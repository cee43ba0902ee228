"""A known piece is looked up once, and a task's counter goes with the task."""

import os
import random
from pathlib import Path

import public_tokenizers
from pyspark import cloudpickle
from tokenizers import Tokenizer

from distillery.llm import token_counts
from distillery.llm.common import hand_back
from distillery.llm.token_counts import Counter

PATH = public_tokenizers.path("word_bpe_49k.json")


class Memo(dict):
    asked = 0

    def get(self, piece):
        Memo.asked += 1
        return super().get(piece)

    def __contains__(self, piece):
        Memo.asked += 1
        return super().__contains__(piece)

    def __getitem__(self, piece):
        Memo.asked += 1
        return super().__getitem__(piece)


def test_known_pieces_are_looked_up_once():
    counter, text = Counter(PATH), "the cat sat on the mat, Día 7. " * 40
    first = counter.ids([text, None, ""])
    counter.memo = Memo(counter.memo)
    again = counter.ids([text, None, "", "mat\nzyx"])
    pieces = len(text) // len("the cat sat on the mat, Día 7. ") * 11 + 1
    assert Memo.asked <= pieces + 10, Memo.asked
    model = Tokenizer.from_file(PATH)
    want = [model.encode(t, add_special_tokens=False).ids for t in (text, "", "", "mat\nzyx")]
    assert [memoryview(x).cast("I").tolist() for x in again] == want and first == again[:3]


def test_a_task_leaves_no_tokenizer_behind():
    counter = token_counts.worker_counter(PATH, memo_pieces=1234)
    assert token_counts.worker_counter(PATH, memo_pieces=1234) is counter
    counter.forget()
    assert counter not in token_counts._counters.values()
    assert token_counts.worker_counter(PATH, memo_pieces=1234) is not counter


def test_tasks_leave_no_cache_of_the_library_behind():
    rng, page = random.Random(4), os.sysconf("SC_PAGE_SIZE")

    def task():
        counter = token_counts.worker_counter(PATH)
        counter.ids([" ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(1_200)) for _ in range(10)])
        counter.forget()
        del counter
        hand_back()
        return int(Path("/proc/self/statm").read_text().split()[1]) * page / 1e6

    held = [task() for _ in range(14)]
    assert held[-1] - held[3] < 20, held  # about 50 with a cache a task


def test_a_used_counter_can_be_sent():
    counter = Counter(PATH)
    want = counter.ids(["the cat"])
    assert cloudpickle.loads(cloudpickle.dumps(counter)).ids(["the cat"]) == want
