"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

LOWER = {code: code + 32 for code in range(65, 91)}


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def shingle_set(text):
    words = spaced_words(text)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[at:at + 5]) for at in range(len(words) - 4))


def near_groups(rows, percent=85):
    """{doc_id: (size of the set, smallest linked doc_id)} of (doc_id, text) with unique ids."""
    sets = {ident: shingle_set(text) for ident, text in rows}
    having = defaultdict(list)
    for ident, own in sets.items():
        for shingle in own:
            having[shingle].append(ident)
    shared = Counter()
    for idents in having.values():
        shared.update((a, b) for a in idents for b in idents if a < b)
    parent = {ident: ident for ident in sets}

    def root(one):
        while parent[one] != one:
            one = parent[one]
        return one

    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {ident: (len(own), root(ident)) for ident, own in sets.items()}


def contamination(docs, items):
    """{doc_id: (words, hit, items, digest, contaminated)}."""
    windows = defaultdict(set)
    for ident, text in items:
        words = plain_words(text)
        if len(words) < 13:
            if words:
                windows[tuple(words)].add(ident)
        for at in range(len(words) - 12):
            windows[tuple(words[at:at + 13])].add(ident)
    found = {}
    for ident, text in docs:
        words = plain_words(text)
        hit, owners = set(), set()
        for window, own in windows.items():
            for at in range(len(words) - len(window) + 1):
                if tuple(words[at:at + len(window)]) == window:
                    hit.update(range(at, at + len(window)))
                    owners |= own
        names = ",".join(sorted(map(str, owners)))
        found[ident] = (len(words), len(hit), len(owners), hashlib.sha256(names.encode()).hexdigest(),
                        bool(hit) and 20 * len(hit) >= len(words))
    return found


def exact_groups(rows):
    """{doc_id: (keep_id, size)} of (doc_id, text) with unique ids."""
    groups = defaultdict(list)
    for ident, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), ident))
    return {ident: (min(group)[1], len(group)) for group in groups.values() for _, ident in group}


def encoding(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def plain_runs(words):
    """(start, length, period) of maximal runs, trying every period."""
    found, size = [], len(words)
    for period in range(1, size // 4 + 1):
        start = 0
        while start + period < size:
            end = start
            while end + period < size and words[end] == words[end + period]:
                end += 1
            length = end - start + period
            if end > start and length >= max(6, 4 * period):
                own = words[start:start + length]
                if all(own[shift:] != own[:-shift] for shift in range(1, period)):
                    found.append((start, length, period))
            start = max(end, start + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def quality_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {place + step for place, window in enumerate(zip(words, words[1:], words[2:]))
              for step in range(3) if windows[window] > 1}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(line in lines[:place] for place, line in enumerate(lines)), len(inside))


def alignments(rows, encode_a, encode_b, bytes_a, bytes_b):
    """{place: (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)} of texts.

    The encoders give ids of a text, the others the bytes of an id.
    """
    links, shapes = [], []
    for text in rows:
        a, b = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        data = (" " + (text or "")).encode()
        if not text or b"".join(map(bytes_a, a)) != data or b"".join(map(bytes_b, b)) != data:
            links.append([])
            shapes.append((0, 0, 0, 0, ""))
            continue
        groups, own = [[[], []]], []
        i = j = end_a = end_b = 0
        while i < len(a) or j < len(b):
            if end_a <= end_b:
                end_a += len(bytes_a(a[i]))
                groups[-1][0].append(a[i])
                i += 1
            else:
                end_b += len(bytes_b(b[j]))
                groups[-1][1].append(b[j])
                j += 1
            if end_a == end_b:
                groups.append([[], []])
        groups.pop()
        for left, right in groups:
            own += [(x, y) for x in left for y in right]
        links.append(own)
        shapes.append((len(a), len(b), len(groups), len(own), ";".join(
            ",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)))
    counts = Counter(pair for own in links for pair in set(own))
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    return [(*shape[:4], sum(counts[pair] == highest[pair[0]] for pair in own),
             sum(counts[pair] for pair in own), shape[4])
            for shape, own in zip(shapes, links, strict=True)]
