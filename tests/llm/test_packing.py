from __future__ import annotations

import random
import sys
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from oreflow.llm import packing
from oreflow.llm.common import per_process, release
from oreflow.llm.packing import Encoder, fullest, pack, plan_sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, length string, salt string, nth string"
TEXTS = ["Plain words, here. And\nthere", "", " lead", "trail ", "two  spaces", "tab\tin it", "a \n b", "x\n\ny z", "é ñandú Über-straße!! 12 3.5", "it's we'll", "nb sp ace", "<|endoftext|> and <|endoftext|>", "\x1c odd \x1f", "日本語 テキスト", "👍🏽 ok"]


def test_encoder_equals_tokenizer():
    plain, mine = Tokenizer.from_file(PATH), Encoder(PATH)
    draw = random.Random(1)
    letters = "ab é\n\t  .,'s1<|>  "
    for text in [*TEXTS, *("".join(draw.choice(letters) for _ in range(30)) for _ in range(3000))]:
        assert np.frombuffer(mine(text), dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("gap", ["\n", "\r\n", "\n\n", "\n\t"])
def test_lines_without_spaces(gap):
    plain, mine = Tokenizer.from_file(PATH), Encoder(PATH)
    draw = random.Random(3)
    lines = [draw.choice(["red", "Fox,", "12", "a,b;c", "été", "it's"]) + str(k % 7) * (k % 3) for k in range(5000)]
    for text in ["\n".join(lines), "lead " + "\n".join(lines) + " trail", "\n".join(lines[:2500]) + gap + "\n".join(lines[2500:])]:
        assert np.frombuffer(mine(text), dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    # Whole texts, lines and words are remembered, no ends of texts.
    assert len(mine.first) + len(mine.rest) < 100


def test_space_free_texts_take_bounded_memory(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", {"first": 200_000, "rest": 400_000, "signs": 20_000})
    plain, mine = Tokenizer.from_file(PATH), Encoder(PATH)
    draw = random.Random(5)
    held = lambda x: sum(sys.getsizeof(k) + sys.getsizeof(v) for d in (x, x.older) for k, v in d.items())
    for n in range(3000):
        text = "".join(chr(draw.randrange(0x4E00, 0x9FFF)) for _ in range(draw.randrange(5, 900))) + "!?" * draw.randrange(40) + " " + f"{draw.random()}" * draw.randrange(1, 9)
        ids = mine(text)
        if n % 100 == 0:
            assert np.frombuffer(ids, dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert held(mine.first) <= 200_000 and held(mine.rest) <= 400_000 and held(mine.rest.signs) <= 20_000
    assert len(mine.first) > 0 and len(mine.rest) > 100


def test_fullest_is_the_best_subset():
    draw = random.Random(2)
    for _ in range(60):
        items = [draw.randint(1, 40) for _ in range(9)]
        room = draw.randint(1, 90)
        best = max(sum(c) for k in range(10) for c in combinations(items, k) if sum(c) <= room)
        counts = {x: items.count(x) for x in items}
        chosen = fullest(counts, room)
        assert sum(k * m for k, m in chosen.items()) == best and all(m <= counts[k] for k, m in chosen.items())


def test_plan_uses_each_piece_once_and_few_sequences():
    draw = random.Random(4)
    counts = defaultdict(int)
    for _ in range(20_000):
        counts[min(2048, int(draw.lognormvariate(6, 1)) + 1)] += 1
    lines = plan_sequences(dict(counts))
    used = defaultdict(int)
    for times, chosen in lines:
        assert sum(k * m for k, m in chosen.items()) <= 2048
        for k, m in chosen.items():
            used[k] += times * m
    assert used == counts and len(lines) < 5000
    assert sum(t for t, _ in lines) <= 1.002 * -(-sum(k * n for k, n in counts.items()) // 2048) + 1


def test_pack(spark):
    plain = Tokenizer.from_file(PATH)
    draw = random.Random(7)
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(100 + k, " ".join(draw.choice(["red", "fox", "Blue."]) for _ in range(draw.randint(1, 400)))) for k in range(150)]
    rows += [(300, "long text " * 9000), (301, None), (None, "no id"), (302, "twice"), (302, "twice")]
    frame = spark.createDataFrame([(i, t, "l", "s", "n") for i, t in rows], SCHEMA)
    got = pack(frame, PATH).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, t in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        own = sorted(by_doc[i], key=lambda r: (r.start, r.sequence_id, r.offset))
        if i == 302:
            assert len(own) == 2 and len({(r.sequence_id, r.offset) for r in own}) == 2
            own = own[:1]
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
        assert all(r.length == 2048 for r in own[1:]) and (len(own) == 1) == (len(ids) <= 2048)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(by_sequence) <= -(-sum(r.length for r in got) // 2048) + 1
    assert pack(frame.limit(0), PATH).count() == 0


@pytest.mark.parametrize("counts", [{}, {2048: 3}, {1: 5000}])
def test_plain_plans(counts):
    assert sum(t for t, _ in plan_sequences(counts)) == -(-sum(k * n for k, n in counts.items()) // 2048)


def test_release_drops_all_but_the_named_object():
    mine, other = per_process("test-mine", list), per_process("test-other", list)
    release(but="test-mine")
    assert per_process("test-mine", list) is mine and per_process("test-other", list) is not other


def test_packing_drops_what_other_operators_keep(spark, monkeypatch):
    docs, steps = spark.createDataFrame([(1, "some words")], "doc_id long, text string"), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda rows, step, schema: steps.append(step))
    packing.pieces(docs, PATH)
    other = per_process("test-other", list)
    encoder = per_process(f"encoder:{PATH}:None", lambda: Encoder(PATH))
    assert list(steps[0](iter([]))) == []
    assert per_process("test-other", list) is not other and per_process(f"encoder:{PATH}:None", list) is encoder
