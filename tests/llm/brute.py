"""Plain Python versions of the contracts, for comparison on small tables."""

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text, w = text or "", words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def targets(totals):
    """totals: {source: tokens}, None last -> {source: target}, by repeated resharing."""
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out, left = {}, set(order)
    while left:
        rest = 1.5 * sum(totals.values()) - sum(out.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 2 * totals[s]}
        if not over:
            return out | share
        out |= {s: 2 * totals[s] for s in over}
        left -= over
    return out


def unit(key, shard):
    return (int(hashlib.md5(f"{key}/{shard}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(text):
    return zlib.crc32((text or "").encode())


def chat(turns):
    """turns: [(role, text)] in order -> n_turns, turns_sha256, loss_chars, loss_sha256."""
    lost = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)), len(lost), sha(lost)
