"""Plain forms of the operators, for small tables."""

import math
import re
from collections import defaultdict

import xxhash

ROWS = "doc_id long, text string, lang string, source string, n_chars long"
FOLDER = "/root/testdata/sf0.001"


def word_set(text):
    w = [x.encode().lower() for x in re.findall("[^\x20\x09-\x0d]+", text or "")]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def line_form(line):
    return b" ".join(line.encode().lower().split()).decode()


def line_set(form):
    return {form[i : i + 8] for i in range(max(1, len(form) - 7))}


def groups(sets, percent=75):
    """{key: smallest key reachable} by links of intersection >= percent of the union."""
    owners = defaultdict(list)
    for key, items in sets.items():
        for x in items:
            owners[x].append(key)
    common = defaultdict(int)
    for keys in owners.values():
        for i, a in enumerate(keys):
            for b in keys[:i]:
                common[a, b] += 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    return roots(sets, links)


def roots(keys, links):
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {k: root(k) for k in keys}


def first_lines(docs):
    """{doc_id: text that is left}, for (doc_id, text) with distinct ids and no nulls."""
    places = {}
    for doc_id, text in sorted(docs):
        for n, line in enumerate(text.split("\n")):
            if form := line_form(line):
                places.setdefault(form, (doc_id, n))
    found = groups({form: line_set(form) for form in places})
    first = {}
    for form, place in places.items():
        first[found[form]] = min(first.get(found[form], place), place)
    stay = set(first.values())
    return {
        d: "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) in stay or not line_form(x)) for d, t in docs
    }


def taken(rows):
    """Copies of each row of (key, source, size, digits), the plain way: sorted by digits."""
    sizes = defaultdict(int)
    for _, source, size, _ in rows:
        sizes[source] += size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_ = {}, set(sizes)
    left = 1.5 * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    out = {}
    for s in sizes:
        once = target[s] >= sizes[s]
        room = target[s] - sizes[s] * once
        rest = sorted((d, size, key) for key, t, size, d in rows if t == s)
        for _ in range(3):
            used, kept, stopped = 0, [], False
            for d, size, key in rest:
                stopped = stopped or used + size > room
                if not stopped:
                    used += size
                    out[key] = 1
                else:
                    kept.append((d, size, key))
            room -= used
            rest = [x for x in kept if x[1] <= room]
        cells = defaultdict(int)
        for key, t, size, d in rows:
            if t == s and key not in out and 0 < size < 2 * room:
                cells[d] += size
        last = min(((abs(n - room), d) for d, n in cells.items() if n < 2 * room), default=(0, None))[1]
        for key, t, _, d in rows:
            if t == s and d == last:
                out[key] = 1
        for key, t, _, _ in rows:
            if t == s:
                out[key] = out.get(key, 0) + once
    return target, out


def spot_signatures(text, anchors, reach):
    """Chains (word, next content word, the one after) at anchors and where none was for long, hashed."""
    whole = 1 << 64
    words = re.findall(rb"[a-z0-9\x80-\xff]+", bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode()))
    if not words:
        return [xxhash.xxh32_intdigest(text.encode())] if text else []

    def number(word):
        return xxhash.xxh3_64_intdigest(word) // 2 * 2 + (word.decode(errors="replace") in anchors)

    def chain(a, b, c, kind):
        h = (a + kind) * 0x9E3779B97F4A7C15 % whole
        h = (h ^ (h >> 31) ^ b) * 0xC2B2AE3D27D4EB4F % whole
        return ((h ^ (h >> 29) ^ c) * 0x165667B19E3779F9 % whole) >> 32

    numbers, out, last = [number(w) for w in words], set(), -reach
    for at, n in enumerate(numbers):
        if n % 2:
            last = at
        if n % 2 or at - last >= reach:
            follow = [m for m in numbers[at + 1 :] if not m % 2][:2]
            if len(follow) == 2:
                out.add(chain(n, *follow, 0))
    if not out:
        padded = numbers + [0, 0]
        out = {chain(*padded[k : k + 3], 1) for k in range(max(1, len(numbers) - 2))}
    return sorted(out)


def rule_score(intercept, rules, numbers):
    """The probability that rules (bounds, weight) give for the numbers of a text."""
    total = intercept
    for bounds, weight in rules:
        if all(numbers[at] > value if above else numbers[at] <= value for at, above, value in bounds):
            total += weight
    return 1 / (1 + math.exp(-total))


def decoded(languages, code, weights, trust, buckets):
    """(language, share) of the codeword with the least weighed loss for the n-grams of a text."""
    losses = []
    for row, own in zip(code, trust, strict=True):
        loss = 0.0
        for bit, (side, sure) in enumerate(zip(row, own, strict=True)):
            margin = sum(float(weights[b][bit]) for b in buckets) / max(1, len(buckets)) * math.sqrt(min(len(buckets), 400))
            loss += sure * math.log1p(math.exp(-side * margin))
        losses.append(loss)
    shares = [math.exp(-(x - min(losses)) * len(code[0])) for x in losses]
    best = max(range(len(shares)), key=lambda k: (shares[k], -k))
    return languages[best], shares[best] / sum(shares)


def byte_grams(text, multipliers, bits):
    """Buckets of the byte n-grams of a text's words, set apart by blanks."""
    letters = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 97 <= b <= 122 else 32 for b in text.encode())
    data = b" " + b" ".join(letters.split()) + b" "
    return [
        int.from_bytes(data[k : k + n]) * factor % (1 << 32) >> (32 - bits)
        for n, factor in multipliers.items()
        for k in range(len(data) - n + 1)
    ]
