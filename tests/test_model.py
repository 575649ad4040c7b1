"""The whole build on random records against a row-by-row model in Python.

The records are as bad as they come: any name may be missing or blank, names
repeat under several parents, labels are dirty, unknown or useless.
"""

import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import fixtures
import pytest
from conftest import rows

from traitvote import Source, Stages, build, label_list
from traitvote.constants import LABEL_PRIORITY
from traitvote.schemas import (
    GROUP_EXCLUSIONS,
    HOMONYM_FLAGS,
    NAME_RULES,
    TAXON_EXCLUSIONS,
    VOCABULARY,
)

FAMILIES = ["Fa", "Fb", "Fc", "Unknown", "", None]
GENERA = ["Ga", "Gb", "Gc", "Gd", None]
EPITHETS = ["a", "b", "c", None]
LABELS = ["Tree", " tree*", "shrub", "HERB ", "odd", "junk", "*", " ", "unseen", None]
MEANINGS = {"tree": "tree", "shrub": "shrub", "herb": "herb", "odd": "odd form", "junk": None}


def make_records(rng, n):
    records = []
    for _ in range(n):
        genus, epithet = rng.choice(GENERA), rng.choice(EPITHETS)
        species = f"{genus or 'Gx'} {epithet}" if epithet else None
        family = rng.choices(FAMILIES, weights=[6, 3, 1, 2, 1, 1])[0]
        records.append((family, genus, species, rng.choice(LABELS)))
    return records


def make_rules(rng):
    """Rules of every scope; the writes are (set, value) per name."""
    rules = {}
    for genus in GENERA[:3]:
        rules["genus_family", genus, "Unknown", None] = [("Fa", genus, "COPY"), (1, 1, 1)]
    rules["genus_family_null_species", "Ga", "Unknown", None] = [("Fb", "Gz", None), (1, 1, 1)]
    rules["species_family", None, "Unknown", "Gb a"] = [("Fc", None, None), (1, 0, 0)]
    rules["species", None, None, "Gb b"] = [(None, None, "Gb renamed"), (0, 0, 1)]
    rules["species", None, None, "Gc a"] = [("Fb", None, None), (1, 1, 1)]
    return rules


def rule_rows(rules, track=True):
    for (scope, genus, family, species), (values, written) in rules.items():
        copies = values[2] == "COPY"
        values = (*values[:2], None if copies else values[2])
        yield (scope, family, genus, species, *values, *map(bool, written), copies, track)


def matched(rules, genus, family, species):
    """Effects of the rules that fit a name, weakest scope first."""
    keys = [
        ("genus_family", genus, family, None) if genus and family else None,
        ("genus_family_null_species", genus, family, None) if species is None else None,
        ("species_family", None, family, species) if species is not None else None,
        ("species", None, None, species) if species is not None else None,
    ]
    return [rules[k] for k in keys if k in rules]


def apply_rules(rules, name, start):
    """``name`` is (family, genus, species); later rules overwrite."""
    result = list(start)
    for values, written in matched(rules, name[1], name[0], name[2]):
        for i in range(3):
            if written[i]:
                result[i] = name[2] if values[i] == "COPY" else values[i]
    return tuple(result)


def model_source(records, strip, flags, rules, fixes, excluded):
    """(current names, original names, updated, label) of the rows that stay."""
    state = []
    for *name, label in records:
        name = tuple(name)
        if name == (None, None, None):
            continue
        state.append([apply_rules(fixes, name, name), name, 0, label])
    families = defaultdict(set)
    for current, *_ in state:
        if current[1] is not None:
            families[current[1]].add(current[0])
    flagged = {
        (g, f) for g, fs in families.items() if len(fs - {None}) > 1 for f in fs if (g, f) in flags
    }
    lines = {}
    for genus, family in flagged:
        species = {c[2] for c, *_ in state if (c[1], c[0]) == (genus, family)}
        for s in species if family is not None else {None}:
            lines[family, genus, s] = apply_rules(rules, (family, genus, s), (None,) * 3)
    kept = []
    for current, orig, _, label in state:
        updated = 0
        if None not in orig and orig in lines:
            current, updated = lines[orig], 1
        whole_genus = (*orig[:2], None)
        if None not in orig[:2] and whole_genus in lines:
            current, updated = (*lines[whole_genus][:2], None), 1
        blank = tuple(None if n is None or not n.strip(" ") else n for n in current)
        if label is not None:
            label = label.lower()
            for text in strip:
                label = label.replace(text, "")
            label = label.strip(" ") or None
        if blank not in excluded and label is not None:
            kept.append((current, orig, updated, label))
    return kept


def rounded(x: Fraction, digits) -> Decimal:
    exact = Decimal(x.numerator) / Decimal(x.denominator)
    return exact.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


def flag_of(score):
    bounds = [("0.90", "very high"), ("0.75", "high"), ("0.50", "med"), ("0.25", "low")]
    return next((flag for bound, flag in bounds if score >= Decimal(bound)), "very low")


def model_vote(votes, rank, digits):
    """``votes`` maps (parents..., taxon, gf) to [obs, ranks]."""
    groups = defaultdict(list)
    for (*parents, taxon, gf), (obs, ranks) in votes.items():
        groups[taxon].append((-obs, -LABEL_PRIORITY.get(gf, 0), gf, *map(first, parents), ranks))
    out = {}
    for taxon, group in groups.items():
        best = min(group, key=lambda v: v[:-1])
        total = -sum(v[0] for v in group)
        parents = tuple(p[1] if p[0] else None for p in best[3:-1])
        out[taxon] = {
            "parents": parents,
            "gf": best[2],
            "obs": -best[0],
            "total": total,
            "prop": rounded(Fraction(-best[0], total), digits),
            "all": ",".join(sorted(v[2] for v in group)),
            "ranks": ",".join(sorted(set().union(*(v[-1] for v in group)))),
            "low_n": rounded(Fraction(min(total, 100) - 100, 500), 2),
        }
    return out


def first(name):
    """NULL sorts before every name."""
    return (name is not None, name or "")


def model_build(kept, taxon, excluded_families):
    counts = Counter()
    for (family, genus, species), _, _, label in kept:
        gf = MEANINGS.get(label)
        if gf is not None and family is not None:
            counts[family, genus, species, gf] += 1
    by_species, by_genus, by_family = ({} for _ in range(3))

    def add(votes, key, obs, *ranks):
        entry = votes.setdefault(key, [0, set()])
        entry[0] += obs
        entry[1].update(ranks)

    for (f, g, s, gf), obs in counts.items():
        if s is not None:
            add(by_species, (f, g, s, gf), obs)
            add(by_family, (f, gf), obs, "species")
        if g is not None:
            add(by_genus, (f, g, gf), obs, "species" if s is not None else "genus")
            add(by_family, (f, gf), obs, "genus")
        if s is None and g is None:
            add(by_family, (f, gf), obs, "family")
    species = model_vote(by_species, "species", 1)
    genus = model_vote(by_genus, "genus", 1)
    family = model_vote(by_family, "family", 2)
    for table in (species, genus):
        for taxon_name in [t for t, v in table.items() if v["parents"][0] in excluded_families]:
            del table[taxon_name]
    for v in species.values():
        v["conf"] = max(v["prop"] + v["low_n"], Decimal(0))
    for table, level in ((genus, 1), (family, 0)):
        for name, v in table.items():
            listed = {t[2] for t in taxon if t[level] == name}
            assessed = [s for s, w in species.items() if w["parents"][level] == name]
            v["spp"], v["spp_gf"] = len(listed), len(assessed)
            v["coverage"] = v["conf"] = None
            if listed:
                lack = Fraction(len(assessed) - len(listed), len(listed)) / 5
                v["coverage"] = rounded(lack, 2)
                v["conf"] = v["prop"] + v["low_n"] + v["coverage"]
            v["conf"] = max(v["conf"] or Decimal(0), Decimal(0))
    return species, genus, family


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_build_equals_the_model(spark, table, tmp_path, seed):
    rng = random.Random(seed)
    records = [make_records(rng, 350), make_records(rng, 250)]
    rules = make_rules(rng)
    flags = {("Ga", "Unknown"), ("Gb", "Unknown"), ("Gc", "Unknown"), ("Gd", None), ("Gd", "Fc")}
    fixes = {("species_family", None, "Fb", "Gd a"): [("Fa", None, None), (1, 0, 0)]}
    excluded = {("Fa", "Gc", None), (None, "Gd", None)}
    taxon = [("Fa", "Ga", f"Ga {i}") for i in "abcdefg"] + [("Fb", "Gb", "Gb a"), ("Fa", "Gd", "Gd a")]

    vocab = table(
        VOCABULARY,
        *((k, gf, None, None, None, int(gf is None)) for k, gf in MEANINGS.items()),
    )
    schema = fixtures.NAMES + ", label string"
    sources = {
        "one": Source(
            table(schema, *records[0]),
            vocab,
            flags=table(HOMONYM_FLAGS, *((g, f, 1, 0) for g, f in flags)),
            rules=table(NAME_RULES, *rule_rows(rules)),
            exclusions=table(TAXON_EXCLUSIONS, *excluded),
        ),
        "two": Source(
            table(schema, *records[1]),
            vocab,
            strip=(),
            fixes=table(NAME_RULES, *rule_rows(fixes, track=False)),
            flags=table(HOMONYM_FLAGS, *((g, f, 1, 0) for g, f in flags)),
            rules=table(NAME_RULES, *rule_rows(rules)),
        ),
    }
    built = build(
        sources,
        table("family string, genus string, species string, taxon_rank string",
              *((*t, "species") for t in taxon)),
        Stages(spark, str(tmp_path)),
        exclusions=table(GROUP_EXCLUSIONS, ("Fc",)),
    )

    one = model_source(records[0], ("*",), flags, rules, {}, excluded)
    two = model_source(records[1], (), flags, rules, fixes, set())
    species, genus, family = model_build(one + two, taxon, {"Fc"})
    assert species and genus and family

    columns = ["gf_cons", "gf_cons_obs", "total_obs", "gf_cons_prop", "gf_all", "penalty_gf_low_n"]
    fields = ["gf", "obs", "total", "prop", "all", "low_n"]
    tail, ends = ["gf_conf", "gf_conf_flag"], ["conf"]

    def model_rows(table, extra):
        return sorted(
            (
                (*v["parents"], name, *(v[k] for k in fields + extra + ends), flag_of(v["conf"]))
                for name, v in table.items()
            ),
            key=repr,
        )

    groups = ["inferred_from_ranks", "spp", "spp_gf", "penalty_spp_gf_low_n"]
    extra = ["ranks", "spp", "spp_gf", "coverage"]
    assert rows(built.species, "family", "genus", "species", *columns, *tail) == model_rows(
        species, []
    )
    assert rows(built.genus, "family", "genus", *columns, *groups, *tail) == model_rows(genus, extra)
    assert rows(built.family, "family", *columns, *groups, *tail) == model_rows(family, extra)
    names = {(*current, *orig) for current, orig, updated, _ in one + two if updated}
    assert names and rows(built.synonyms) == sorted(names, key=repr)

    given = sorted({(r[0], r[2]) for part in records for r in part}, key=repr)

    def label(f, g, s):
        for table, key, method in (
            (species, s, "direct from species"),
            (genus, g, "imputed from genus"),
            (family, f, "imputed from family"),
        ):
            if key in table:
                v = table[key]
                return v["gf"], v["conf"], flag_of(v["conf"]), method
        return None, None, None, None

    accepted = {}
    for name in names:
        current, orig = name[:3], name[3:]
        order = (current[2] is None, *((n is None, n or "") for n in current))
        accepted[orig] = min(accepted.get(orig, (order, current)), (order, current))
    wanted = []
    for f, s in given:
        g = None if s is None else s.split(" ")[0]
        found = accepted.get((f, g, s)) if None not in (f, g, s) else None
        final = found[1] if found else (f, g, s)
        wanted.append((f, s, *label(*final), 1 if found else None))
    done = label_list(table("family string, species string", *given), built, correct_synonyms=True)
    got = rows(done, "family", "species", "gf", "gf_conf", "gf_conf_flag", "gf_method", "name_updated")
    assert got == sorted(wanted, key=repr)
