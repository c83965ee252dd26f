"""The contracts of the queries, stated plainly and slowly in Python."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    twice = {i + k for found in places.values() if len(found) > 1 for i in found for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(twice)
    )


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(sets):
    """Smallest id of each id's component, for {id: shingle set}."""
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = [i for i in sorted(sets) if sets[i]]
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if 4 * both >= 3 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def substring_dedup(texts, length=100):
    """[(bytes, removed, runs, digest of the rest)] for texts in order."""
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def line_dedup(texts, min_lines=2, long_words=50):
    """[(worded lines, removed, runs, text)] for texts in order."""
    seen, alone, out = set(), set(), []
    for text in texts:
        if text is None:
            out.append((0, 0, 0, None))
            continue
        lines = text.split("\n")
        at = [i for i, line in enumerate(lines) if WORD.search(line)]
        gone = set()
        for k in range(len(at) - min_lines + 1):
            window = tuple(lines[i] for i in at[k : k + min_lines])
            if window in seen:
                gone.update(range(k, k + min_lines))
            seen.add(window)
        for k, i in enumerate(at):
            if len(WORD.findall(lines[i])) >= long_words:
                if lines[i] in alone:
                    gone.add(k)
                alone.add(lines[i])
        places = {at[k] for k in gone}
        kept = "" if gone and len(gone) == len(at) else "\n".join(x for i, x in enumerate(lines) if i not in places)
        out.append((len(at), len(gone), sum(k - 1 not in gone for k in gone), kept))
    return out
