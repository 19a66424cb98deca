from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from oreflow.llm import align as module
from oreflow.llm.align import align, alignment, byte_letters, byte_level, piece, shared_cuts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, row string, pair string, total string, groups string"
ODD = ["", " lead", "trail ", "two  spaces", "tab\tin", "a \n b", "x\n\ny z", "é ñandú Über-straße!! 12 3.5", "it's", "nb sp ace", "<|endoftext|> and <s>", "\x1c odd \x1f", "日本語 テキスト", "👍🏽 ok", "a▁b", "é ﬁ", "\x00"]


@pytest.fixture(scope="module")
def plain():
    tokenizer, model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tokenizer.encode_special_tokens = True
    letters = byte_letters()

    def of(text):
        """(id, bytes) of both, the plain way; None where they don't spell the text."""
        a = [(i, bytes(letters[c] for c in tokenizer.id_to_token(i))) for i in tokenizer.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in model.encode(text):
            name = model.id_to_piece(i)
            b.append((i, bytes([int(name[3:5], 16)]) if len(name) == 6 and name.startswith("<0x") else name.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (a, b) if text and b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else None

    return of


def groups_of(a, b):
    """Groups by walking along both."""
    out, x, y, i, j, at_a, at_b = [], [], [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            x.append(a[i][0])
            at_a += len(a[i][1])
            i += 1
        else:
            y.append(b[j][0])
            at_b += len(b[j][1])
            j += 1
        if at_a == at_b and x and y:
            out.append((x, y))
            x, y = [], []
    return out


def brute(plain, rows):
    found = [(i, plain(t or "")) for i, t in rows]
    every = [(i, groups_of(*p) if p else [], p or ([], [])) for i, p in found]
    counts = Counter((g[0][-1], g[1][-1]) for _, gs, _ in every for g in gs)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for i, gs, (a, b) in every:
        links = [(g[0][-1], g[1][-1]) for g in gs]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs)
        out.append((i, len(a), len(b), len(gs), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), sha256(text.encode()).hexdigest() if gs else ""))
    return sorted(out, key=repr)


def corpus():
    draw = random.Random(6)
    letters = "abcde éñ\n\t  .,'12 <|>日🙂"
    rows = [(None, "no id here"), (1, None), (7, "again again"), (7, "again again"), (8, "base64" * 4000), (9, "日本" * 3000)]
    rows += [(100 + k, t) for k, t in enumerate(ODD)]
    rows += [(200 + k, "".join(draw.choice(letters) for _ in range(draw.randrange(1, 60)))) for k in range(300)]
    return rows + [(600 + k, " ".join(draw.choice(["tokens", "alignment,", "Straße", "unbelievable.", "x1y2", "of", "the"]) for _ in range(50))) for k in range(60)]


@pytest.mark.parametrize("aligned, pairs", [(module.ALIGNED, module.BROADCAST_PAIRS), (300, 40), (1, 1)])
def test_equals_brute_force(spark, monkeypatch, plain, aligned, pairs):
    monkeypatch.setattr(module, "ALIGNED", aligned)
    rows = corpus()
    got = alignment(spark.createDataFrame([(i, t, "r", "p", "t", "g") for i, t in rows], SCHEMA).repartition(5), A, B, pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(plain, rows)


def test_words_are_encoded_as_in_the_text(plain):
    one, other = byte_level(A), piece(B)
    for _, text in corpus():
        want = plain(text or "")
        if want:
            assert (one.ids(text).tolist(), other.ids(text).tolist()) == tuple([i for i, _ in side] for side in want)
            assert one.spelled(one.ids(text)).tobytes() == other.spelled(other.ids(text)).tobytes() == (" " + text).encode()


def test_remembered_words_take_bounded_memory(monkeypatch):
    monkeypatch.setattr(module, "REMEMBERED", 100_000)
    side = piece(B)
    for k in range(3000):
        text = f"word{k} {'x' * 500}{k}"
        side.learn([text])
        side.ids(text)
    assert side.words.size <= 50_000 and side.words.older and all(len(w) <= 64 for w in [*side.words, *side.words.older])


def test_shared_cuts_are_all_common_ends():
    rng = np.random.default_rng(3)
    for dense in (0.02, 0.3, 0.9):
        a_all, b_all, bounds_a, bounds_b, base = [], [], [0], [0], 0
        for _ in range(40):
            n = int(rng.integers(1, 200))
            for ends, bounds in ((a_all, bounds_a), (b_all, bounds_b)):
                own = np.flatnonzero(rng.random(n) < dense) + 1
                ends.extend((np.union1d(own, [n]) + base).tolist())
                bounds.append(len(ends))
            base += n
        a, b = np.array(a_all), np.array(b_all)
        x, y = np.array(bounds_a), np.array(bounds_b)
        i, j = shared_cuts(a, b, x[:-1], x[1:], y[:-1], y[1:])
        assert a[i].tolist() == b[j].tolist() == np.intersect1d(a, b).tolist()


def test_groups_are_the_operators_output(spark, plain):
    text = "Ünlike tokenizers, 日本語"
    got = align(spark.createDataFrame([(1, text, "", "", "", "")], SCHEMA), A, B).first()
    assert got.groups == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups_of(*plain(text)))
    assert sum(got.times) == got.groups.count(";") + 1


def test_empty_table(spark):
    assert alignment(spark.createDataFrame([], SCHEMA), A, B).count() == 0
