"""What the units of the byte-string search send to each other."""

import random

import numpy as np

from newscorpus.llm import suffixes


def _answers(asked, with_ids):
    """Bits that the units' ranks get, as if each rank had met those of the others."""
    every = {}
    for k, ranks in enumerate(asked):
        for rank, least in zip(ranks.distinct.tolist(), ranks.least.tolist()):
            every.setdefault(rank, []).append((least, k))
    out = []
    for k, ranks in enumerate(asked):
        bits = [
            any(u != k and (not with_ids or i < least) for i, u in every[rank])
            for rank, least in zip(ranks.distinct.tolist(), ranks.least.tolist())
        ]
        rows = []
        for group in np.unique(ranks.group):
            own = np.array(bits, bool)[ranks.group == group]
            rows.append({"range": int(group), "bits": np.packbits(own).tobytes()})
        out.append(rows)
    return out


def test_only_windows_that_nearly_repeat_send_their_whole_hash():
    """Texts share 30 bytes here and there, too few for a window, and one passage of 80."""
    rng = random.Random(4)

    def letters(n):
        return bytes(rng.choices(range(97, 123), k=n))

    short, passage, texts = [letters(30) for _ in range(40)], letters(80), []
    for k in range(6):
        parts = [x for s in short for x in (s, letters(60))]
        texts.append(b"".join([*parts[: 2 * k + 4], *([passage] if k in (1, 4) else []), *parts[2 * k + 4 :]]))
    units = [
        suffixes.Unit(np.array([2 * k, 2 * k + 1]), np.array([len(a), len(b)]), a + b, 50)
        for k, (a, b) in enumerate(zip(texts[::2], texts[1::2]))
    ]
    searches = [suffixes.Search(u, 3) for u in units]
    answers = _answers([s.first for s in searches], False)
    answers = _answers([s.rerank_runs(a) for s, a in zip(searches, answers)], True)
    answers = _answers([s.rerank_grams(a) for s, a in zip(searches, answers)], False)
    open_ = sum(len(s.left) for s in searches)
    sent = [s.rerank_windows(a) for s, a in zip(searches, answers)]
    assert open_ > 1000 and sum(len(r.distinct) for r in sent) < open_ / 10
    answers = _answers(sent, True)
    gone = np.concatenate([s.removed(a) for s, a in zip(searches, answers)])
    whole, want = b"".join(texts), np.zeros(sum(map(len, texts)), bool)
    again = whole.rindex(passage)
    want[again : again + 80] = True
    assert gone.tolist() == want.tolist()


def test_ranks_that_only_exclude_have_40_bits():
    unit = suffixes.Unit(np.array([1]), np.array([4000]), random.Random(1).randbytes(4000), 50)
    ranks = suffixes.Search(unit, 8).first.distinct
    assert 1 << 34 < int(ranks.max()) < 1 << 40
