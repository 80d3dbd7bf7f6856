"""Licence scans against a plain version of the whole scan: units, families, places."""

import math
import random
import re

from hearthgrid.llm import licences as lic

CUE = re.compile(lic.CUE_LINE)
OWN = {family: {w for t in ts for w in lic.words_of(t)} for family, ts in lic.TEMPLATES.items()}
WEIGHTS, BIAS = lic.model()


def families(line):
    """{family: (probability, share, own cue words)} that a unit is reported for."""
    words = lic.words_of(line)
    z = list(BIAS)
    for g in lic.grams_of(words):
        for i, w in enumerate(WEIGHTS.get(g, ())):
            z[i] += w
    total = sum(math.exp(v - max(z)) for v in z)
    met = []
    for i, family in enumerate(lic.FAMILIES[:-1]):
        if z[i] <= z[-1]:
            continue
        shares = {}
        for template in lic.TEMPLATES[family]:
            wanted = set(lic.words_of(template))
            share = len(set(words) & wanted) / len(wanted)
            if share >= lic.COMMON:
                shares[template] = (share, set(words) & wanted & lic._CUES)
        if shares:
            met.append((math.exp(z[i] - max(z)) / total, family, max(s for s, _ in shares.values()), set().union(*(c for _, c in shares.values()))))
    chosen = []
    for x in sorted(met, key=lambda m: (-m[0], m[1])):
        if all(x[3] - OWN[y[1]] for y in chosen):
            chosen.append(x)
    total = sum(x[0] for x in chosen)
    out = {f: (round(p / max(1 - total + p, p), 6), share, own) for p, f, share, own in chosen}
    return {f: v for f, v in out.items() if v[0] >= lic.CERTAIN}


def units(lines):
    """(first line, last line, text) of single lines and of runs of neighbouring ones that hold a cue."""
    out = [(i, i, line) for i, line in enumerate(lines) if CUE.search(line)]
    run_words = lambda line: [w for w in re.split(lic._NOT_RUN, line) if w]
    for i, line in enumerate(lines):
        if not re.findall(lic._RUN_WORD, line):
            continue
        inner = 0
        for last in range(i + 1, len(lines)):
            if not re.search(r"\S", lines[last]) or inner >= lic.LONGEST - 1 or last > i + lic.LONGEST:
                break
            n = len(re.findall(lic._RUN_WORD, lines[last]))
            if n and any(CUE.search(x) for x in lines[i : last + 1]):
                text = " ".join([*run_words(line)[-lic.LONGEST :], *lines[i + 1 : last], *run_words(lines[last])[: lic.LONGEST]])
                if CUE.search(text):
                    out.append((i, last, text))
            inner += n
    return out


def plain(text):
    found = {}
    for first, last, unit in units((text or "").split("\n")):
        for family, (p, share, own) in families(unit).items():
            found.setdefault(family, []).append((last - first, -share, first, last, p, own))
    kept = []
    for family, every in found.items():
        own_kept = []
        for width, share, first, last, p, own in sorted(every, key=lambda x: (*x[:5], sorted(x[5]))):
            if all(last < a or b < first for _, _, a, b, _, _ in own_kept):
                own_kept.append((width, share, first, last, p, own))
        kept += [(family, *x) for x in own_kept]
    rest = [
        (first, family, p)
        for family, width, _, first, last, p, own in kept
        if not any(g != family and a <= first and last <= b and w > width and not own - OWN[g] for g, w, _, a, b, _, _ in kept)
    ]
    rest.sort()
    return len((text or "").split("\n")), len(rest), ",".join(sorted({f for _, f, _ in rest})), ",".join(f"{n}:{f}" for n, f, _ in rest)


def texts():
    draw = random.Random(11)
    templates = [t for ts in lic.TEMPLATES.values() for t in ts]
    filler = "the house of seven and a river that runs quietly under old trees by night".split()
    out = [None, "", "\n\n", "license", "MIT\nLICENSE\nMIT", *templates]
    for _ in range(120):
        parts = []
        for _ in range(draw.randrange(1, 6)):
            words = draw.choice([*templates, *lic.NOTHING]).split()
            words = [w for w in words if draw.random() > 0.07]
            words[:0] = draw.sample(filler, draw.randrange(4))
            words += draw.sample(filler, draw.randrange(4))
            if draw.random() < 0.5:  # wrapped
                at = sorted(draw.sample(range(len(words)), min(len(words), draw.randrange(1, 4))))
                for i in reversed(at):
                    words.insert(i, "\n")
            text = " ".join(words).replace(" \n ", "\n")
            parts.append(text.title() if draw.random() < 0.3 else text)
        out.append(draw.choice(["\n", "\n\n", ". "]).join(parts))
    return out


def test_the_whole_scan(docs):
    rows = list(enumerate(texts()))
    got = {r["doc_id"]: (r["n_lines"], r["n_licences"], r["families"], r["lines"]) for r in lic.digest(docs(rows)).collect()}
    wrong = [(i, t, got[i], plain(t)) for i, t in rows if got[i] != plain(t)]
    assert not wrong, (len(wrong), wrong[:2])
    assert sum(n > 0 for _, n, _, _ in got.values()) > 60


def test_the_scan_of_the_corpus(corpus):
    rows = {r["doc_id"]: r["text"] for r in corpus.collect()}
    for r in lic.digest(corpus).collect():
        assert (r["n_lines"], r["n_licences"], r["families"], r["lines"]) == plain(rows[r["doc_id"]]), r["doc_id"]
