"""Brute-force versions of the operators, by their definitions alone."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACE = "\x20\x09-\x0d"


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def repeated_bytes(docs, length=200):
    """(id, text) pairs to a list of (id, n_bytes, n_removed, n_spans, kept_sha256)."""
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(d[n:n + length] for _, d in data for n in range(len(d) - length + 1))
    out = []
    for i, d in data:
        gone, done = bytearray(len(d)), 0
        for n in range(len(d) - length + 1):
            if seen[d[n:n + length]] > 1:
                start = max(n, done)
                gone[start:n + length] = b"\1" * (n + length - start)
                done = n + length
        spans = sum(1 for n, g in enumerate(gone) if g and not (n and gone[n - 1]))
        out.append((i, len(d), sum(gone), spans, sha(bytes(b for b, g in zip(d, gone) if not g))))
    return out


def luhn(digits):
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_pii(text):
    """kind:start:end, joined."""
    out, t = [], text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, f"email:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(re.fullmatch("0*([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])", p) for p in m[0].split(".")):
            out.append((m.start(), 1, f"ip:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, f"card:{m.start()}:{m.end()}"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, f"phone:{m.start()}:{m.end()}"))
    return ",".join(s for *_, s in sorted(out))


def shingles(text):
    words = re.findall(f"[^{SPACE}]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else ())
    return frozenset(tuple(words[n:n + 5]) for n in range(len(words) - 4))


def components(docs):
    """(id, text) pairs to {id: (n_shingles, component)}; ids may repeat with equal texts."""
    sets = {i: shingles(t) for i, t in docs}
    at = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            at[x].append(i)
    common = Counter((a, b) for ids in at.values() for n, a in enumerate(ids) for b in ids[n + 1:])
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), c in common.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    t = text or ""
    words = re.findall(f"[^{SPACE}]+", t)
    lines = [x for x in t.split("\n") if re.search(f"[^{SPACE}]", x)]
    grams = [tuple(words[n:n + 3]) for n in range(len(words) - 2)]
    counts = Counter(grams)
    covered = {n + k for n, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
            len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words))


def stretch_distance(item, words):
    """The least edits from an item to any stretch of words."""
    before = [0] * (len(words) + 1)
    for n, x in enumerate(item, 1):
        row = [n]
        for k, y in enumerate(words, 1):
            row.append(min(before[k] + 1, row[-1] + 1, before[k - 1] + (x != y)))
        before = row
    return min(before)


def trie(rows):
    """(conv_id, turn, role, text) rows to the sorted rows of the nodes of all rebuilt conversations."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            key = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, key, role or "", text or ""))
    for turns in own.values():
        turns.sort()
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - c % 100
        paths[c] = tuple(t[3:] for t in own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = Counter(), Counter()
    for node, ids in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(ids) - 1) * len(node[-1][1]) if node else 0
    return sorted((ids[0], len(node), members[node[:-1]][0] if node else None, len(ids), len(children[node]) if node in children else 0,
                   leaves[node], saved[node], sha(",".join(str(c) for c in ids if paths[c] == node)))
                  for node, ids in list(members.items()))


def divergence(docs, top=200):
    """(lang, source, text) rows to the sorted rows of pairs and terms."""
    count, found = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        count[lang or "", source or ""].update(terms)
        found[lang or ""].update(set(terms))
    out = []
    for lang in found:
        kept = [t for t, n in found[lang].items() if n >= 3]
        sources = [s for x, s in count if x == lang]
        total = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        share = {s: {t: 1 + 10**9 * (count[lang, s][t] + 1) // (total[s] + len(kept)) for t in kept} for s in sources}
        whole = {t: 1 + 10**9 * (sum(count[lang, s][t] for s in sources) + 1) // (sum(total.values()) + len(kept)) for t in kept}
        far = lambda p, q: (p - q) ** 2 // q
        for s in sources:
            pair = [(-sum(far(share[s][t], share[x][t]) for t in kept), x.encode()) for x in sources if x != s]
            term = [(-far(share[s][t], whole[t]), t.encode()) for t in kept if count[lang, s][t] and share[s][t] > whole[t]]
            for part, rows in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, x.decode(), -v, n + 1) for n, (v, x) in enumerate(rows)]
    return sorted(out)


def simhash(docs, most=3):
    """(id, text) pairs to {id: (fingerprint, component)}."""
    prints = {}
    for i, t in docs:
        words = re.findall(f"[^{SPACE}]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        grams = [" ".join(words[n:n + 3]) for n in range(max(len(words) - 2, min(len(words), 1)))]
        hashes = [xxhash.xxh64_intdigest(g.encode("utf-8", "surrogatepass"), 42) for g in grams]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= most:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (f"{p:016x}", find(i)) for i, p in prints.items()}
