"""The queries in SQL, written independently, for a second engine."""

from __future__ import annotations

_INPUTS = """
known AS (
  SELECT r_name AS family, n_name AS genus, n_name || ' ' || c_name AS species,
         c_custkey, c_name, c_mktsegment
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey),
unrecorded AS (
  SELECT s_suppkey, s_name,
    CASE WHEN s_suppkey % 3 = 2 THEN r_name || ' PROVINCE' ELSE r_name END AS family,
    CASE WHEN s_suppkey % 3 = 0 THEN n_name ELSE 'Supplied' || n_nationkey END AS genus
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey),
taxon AS (
  SELECT c_custkey AS taxon_id, family, genus, species, 'species' AS taxon_rank FROM known
  UNION ALL SELECT 500000000 + s_suppkey, family, genus, genus || ' ' || s_name, 'species'
    FROM unrecorded
  UNION ALL SELECT 1000000000 + n_nationkey, r_name, n_name, NULL, 'genus'
    FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 2000000000 + r_regionkey, r_name, NULL, NULL, 'family' FROM region),
trait_rows AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 97 = 0 THEN 'Unknown' ELSE family END AS family,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE genus END AS genus,
    CASE WHEN o_orderkey % 20 = 0 OR o_orderkey % 50 = 0 THEN NULL ELSE species END AS species,
    CASE o_orderkey % 7 WHEN 0 THEN '* ' || o_orderpriority
                        WHEN 1 THEN lower(o_orderpriority) || ' '
                        ELSE o_orderpriority END AS label,
    family AS country, genus AS state_province, c_name, c_mktsegment, o_orderstatus
  FROM orders JOIN known ON o_custkey = c_custkey),
traits AS (SELECT id, family, genus, species, label FROM trait_rows),
sparse AS (
  SELECT id, CASE WHEN id % 4 <> 0 THEN family END AS family, genus, species, label FROM traits),
observation_rows AS (
  SELECT l_orderkey * 10 + l_linenumber AS id,
    CASE WHEN l_linestatus = 'O' THEN 'plot' ELSE 'specimen' END AS observation_type,
    c_mktsegment AS datasource,
    CASE WHEN l_orderkey % 89 = 0 THEN 'Unknown' ELSE family END AS family,
    CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE genus END AS genus,
    CASE WHEN l_orderkey % 20 = 0 OR l_orderkey % 50 = 0 THEN NULL ELSE species END AS species,
    l_returnflag || l_linestatus AS label
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN known ON o_custkey = c_custkey
  WHERE l_orderkey % 25 <> 0),
observations AS (SELECT id, family, genus, species, label FROM observation_rows),
trait_vocab(gf_verbatim, gf, is_woody, substrate, other, is_useless) AS (VALUES
  ('1-urgent', 'tree', 1, 'terrestrial', NULL, 0),
  ('2-high', 'shrub', 1, 'terrestrial', NULL, 0),
  ('3-medium', 'herb', 0, 'terrestrial', 'annual', 0),
  ('4-not specified', NULL, NULL, NULL, NULL, 1),
  ('5-low', 'liana', 1, 'climber', NULL, 0)),
observation_vocab(gf_verbatim, gf) AS (VALUES
  ('ro', 'tree'), ('rf', 'shrub'), ('ao', 'liana'), ('af', 'hemiepiphyte'),
  ('no', 'herb'), ('nf', 'vine')),
places AS (
  SELECT n_nationkey, n_name AS genus, r_name AS family
  FROM nation JOIN region ON n_regionkey = r_regionkey),
clean AS (
  SELECT id, family, genus, species, trim(replace(lower(label), '*', '')) AS label FROM traits),
"""

_CORRECTED = """
flags AS (
  SELECT genus, 'Unknown' AS family, n_nationkey % 2 AS odd FROM places
  UNION ALL SELECT genus, NULL, 0 FROM places WHERE n_nationkey % 8 = 1),
homonyms AS (
  SELECT DISTINCT genus, family FROM traits WHERE genus IN (
    SELECT genus FROM traits GROUP BY genus HAVING count(DISTINCT family) > 1)),
review AS (
  SELECT DISTINCT h.genus, h.family, t.species
  FROM homonyms h
  JOIN flags f ON f.genus = h.genus AND f.family IS NOT DISTINCT FROM h.family
  LEFT JOIN traits t ON t.genus = h.genus AND t.family = h.family),
accepted AS (
  SELECT r.genus, r.family, r.species,
    CASE WHEN n_nationkey % 2 = 0 THEN p.family END AS acc_family,
    CASE WHEN r.species IS NULL AND n_nationkey % 4 = 2 THEN p.genus || '_ALT'
         WHEN n_nationkey % 2 = 0 THEN p.genus END AS acc_genus,
    CASE WHEN c_custkey % 40 = 5 THEN r.species || ' renamed'
         WHEN n_nationkey % 2 = 0 THEN r.species END AS acc_species
  FROM review r JOIN places p ON p.genus = r.genus
  LEFT JOIN known x ON x.species = r.species),
corrected AS (
  SELECT t.id, t.label, t.family AS family_orig, t.genus AS genus_orig, t.species AS species_orig,
    CASE WHEN g.genus IS NOT NULL THEN g.acc_family
         WHEN s.genus IS NOT NULL THEN s.acc_family ELSE t.family END AS family,
    CASE WHEN g.genus IS NOT NULL THEN g.acc_genus
         WHEN s.genus IS NOT NULL THEN s.acc_genus ELSE t.genus END AS genus,
    CASE WHEN g.genus IS NOT NULL THEN NULL
         WHEN s.genus IS NOT NULL THEN s.acc_species ELSE t.species END AS species,
    CAST(g.genus IS NOT NULL OR s.genus IS NOT NULL AS SMALLINT) AS name_updated
  FROM traits t
  LEFT JOIN accepted s ON s.family = t.family AND s.genus = t.genus AND s.species = t.species
  LEFT JOIN accepted g ON g.family = t.family AND g.genus = t.genus AND g.species IS NULL),
synonyms AS (
  SELECT DISTINCT family, genus, species, family_orig, genus_orig, species_orig
  FROM corrected WHERE name_updated = 1),
one_synonym AS (
  SELECT DISTINCT ON (family_orig, genus_orig, species_orig) *
  FROM synonyms
  ORDER BY family_orig, genus_orig, species_orig, species IS NULL,
           family NULLS LAST, genus NULLS LAST, species NULLS LAST),
"""

# The observations: some names fixed first, then corrected by rules of their own.
_CORRECTED_OBSERVATIONS = """
fixed AS (
  SELECT o.id, o.label, o.family AS family_orig, o.genus, o.species,
    CASE WHEN o.family = 'Unknown' AND x.c_custkey % 5 = 0 THEN x.family ELSE o.family END
      AS family,
    coalesce(o.family = 'Unknown' AND x.c_custkey % 35 = 0, false) AS tracked
  FROM observations o LEFT JOIN known x ON x.species = o.species),
obs_homonyms AS (
  SELECT DISTINCT genus, family FROM fixed WHERE genus IN (
    SELECT genus FROM fixed GROUP BY genus HAVING count(DISTINCT family) > 1)),
obs_accepted AS (
  SELECT DISTINCT h.genus, h.family, o.species,
    CASE WHEN n_nationkey % 2 = 0 THEN p.family END AS acc_family,
    CASE WHEN n_nationkey % 4 = 0 THEN 'A_' || p.genus
         WHEN n_nationkey % 2 = 0 THEN p.genus END AS acc_genus,
    CASE WHEN n_nationkey % 2 = 0 THEN o.species END AS acc_species
  FROM obs_homonyms h
  JOIN flags f ON f.genus = h.genus AND f.family IS NOT DISTINCT FROM h.family
  JOIN places p ON p.genus = h.genus
  LEFT JOIN fixed o ON o.genus = h.genus AND o.family = h.family),
obs_corrected AS (
  SELECT o.id, o.label, o.family_orig, o.genus AS genus_orig, o.species AS species_orig,
    CASE WHEN g.genus IS NOT NULL THEN g.acc_family
         WHEN s.genus IS NOT NULL THEN s.acc_family ELSE o.family END AS family,
    CASE WHEN g.genus IS NOT NULL THEN g.acc_genus
         WHEN s.genus IS NOT NULL THEN s.acc_genus ELSE o.genus END AS genus,
    CASE WHEN g.genus IS NOT NULL THEN NULL
         WHEN s.genus IS NOT NULL THEN s.acc_species ELSE o.species END AS species,
    tracked OR g.genus IS NOT NULL OR s.genus IS NOT NULL AS updated
  FROM fixed o
  LEFT JOIN obs_accepted s ON s.family = o.family_orig AND s.genus = o.genus
    AND s.species = o.species
  LEFT JOIN obs_accepted g ON g.family = o.family_orig AND g.genus = o.genus
    AND g.species IS NULL),
kept_traits AS (
  SELECT * FROM corrected c
  WHERE NOT EXISTS (
    SELECT 1 FROM places p WHERE n_nationkey % 5 = 2 AND p.family = c.family
      AND p.genus = c.genus AND c.species IS NULL)),
build_synonyms AS (
  SELECT family, genus, species, family_orig, genus_orig, species_orig
  FROM kept_traits WHERE name_updated = 1
  UNION
  SELECT family, genus, species, family_orig, genus_orig, species_orig
  FROM obs_corrected WHERE updated),
one_build_synonym AS (
  SELECT DISTINCT ON (family_orig, genus_orig, species_orig) *
  FROM build_synonyms
  ORDER BY family_orig, genus_orig, species_orig, species IS NULL,
           family NULLS LAST, genus NULLS LAST, species NULLS LAST),
"""

# Where the votes of the traits come from: the rows as they are, or corrected
# and without the excluded genus records.
_PLAIN_TRAITS = "SELECT family, genus, species, label FROM traits"
_PLAIN_OBSERVATIONS = "SELECT family, genus, species, label FROM observations"
_CORRECTED_TRAITS = "SELECT family, genus, species, label FROM kept_traits"
_KEPT_OBSERVATIONS = "SELECT family, genus, species, label FROM obs_corrected"


def _build(trait_rows: str, observation_rows: str, curated: bool) -> str:
    """Votes, consensus and scores over the given rows."""
    kept = "WHERE family NOT IN ('ASIA', 'MIDDLE EAST')" if curated else ""
    kept_genera = "WHERE family <> 'MIDDLE EAST'" if curated else ""
    size = """CASE gf WHEN 'tree' THEN 7 WHEN 'shrub' THEN 6 WHEN 'liana' THEN 5
      WHEN 'bambusoid' THEN 4 WHEN 'subshrub' THEN 3 WHEN 'vine' THEN 2 WHEN 'herb' THEN 1
      ELSE 0 END"""
    if curated:
        family_final = """
  SELECT family,
    CASE family WHEN 'ASIA' THEN 'vine' WHEN 'EUROPE' THEN 'hemiepiphyte'
                WHEN 'MIDDLE EAST' THEN 'liana' ELSE gf_cons END AS gf_cons,
    CASE family WHEN 'EUROPE' THEN 25 ELSE gf_cons_obs END AS gf_cons_obs,
    total_obs,
    CAST(CASE family WHEN 'EUROPE' THEN 0.20 WHEN 'MIDDLE EAST' THEN 1.00
         ELSE gf_cons_prop END AS DECIMAL(5,2)) AS gf_cons_prop,
    CASE family WHEN 'ASIA' THEN 'vine' WHEN 'MIDDLE EAST' THEN 'liana' ELSE gf_all END AS gf_all,
    CASE WHEN family <> 'MIDDLE EAST' THEN inferred_from_ranks END AS inferred_from_ranks,
    CASE WHEN family IN ('ASIA', 'EUROPE', 'MIDDLE EAST')
         THEN 'corrected by hand' END AS notes
  FROM family_vote"""
    else:
        family_final = "SELECT *, CAST(NULL AS VARCHAR) AS notes FROM family_vote"
    low_n = """CAST(-((2 * (100 - least(total_obs, 100)) + 5) // 10) * CAST(0.01 AS DECIMAL(3,2))
      AS DECIMAL(3,2))"""
    coverage = """CASE WHEN spp > 0 THEN CAST(
        -sign(spp - spp_gf) * ((40 * abs(spp - spp_gf) + spp) // (2 * spp))
        * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(3,2)) END"""
    flag = """CASE WHEN gf_conf >= 0.90 THEN 'very high' WHEN gf_conf >= 0.75 THEN 'high'
      WHEN gf_conf >= 0.50 THEN 'med' WHEN gf_conf >= 0.25 THEN 'low'
      WHEN gf_conf < 0.25 THEN 'very low' END"""

    def tenths(part: str, whole: str) -> str:
        return f"CAST(((20 * {part} + {whole}) // (2 * {whole})) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(4,1))"

    def hundredths(part: str, whole: str) -> str:
        return f"CAST(((200 * {part} + {whole}) // (2 * {whole})) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(5,2))"

    def group_scores(rank: str) -> str:
        return f"""
  SELECT *, {flag} AS gf_conf_flag FROM (
    SELECT *, CAST(greatest(CAST(gf_cons_prop + penalty_gf_low_n + penalty_spp_gf_low_n
        AS DECIMAL(12,2)), 0) AS DECIMAL(3,2)) AS gf_conf
    FROM (SELECT *, {low_n} AS penalty_gf_low_n, {coverage} AS penalty_spp_gf_low_n,
            CASE WHEN spp > 0 THEN CAST(spp_gf AS DOUBLE) / CAST(spp AS DOUBLE) END AS spp_gf_prop
          FROM (SELECT v.*, coalesce(n.spp, 0) AS spp, coalesce(a.spp_gf, 0) AS spp_gf
                FROM {rank}_final v
                LEFT JOIN (SELECT {rank}, count(DISTINCT species) AS spp FROM taxon
                           WHERE taxon_rank = 'species' GROUP BY {rank}) n USING ({rank})
                LEFT JOIN (SELECT {rank}, count(DISTINCT species) AS spp_gf FROM species_final
                           WHERE gf_cons IS NOT NULL GROUP BY {rank}) a USING ({rank}))))"""

    return f"""
voted_traits AS ({trait_rows}),
voted_observations AS ({observation_rows}),
std AS (
  SELECT t.family, t.genus, t.species, v.gf, 'traits' AS source
  FROM voted_traits t JOIN trait_vocab v ON v.gf_verbatim = trim(replace(lower(t.label), '*', ''))
  WHERE v.is_useless = 0 AND v.gf IS NOT NULL
  UNION ALL
  SELECT o.family, o.genus, o.species, v.gf, 'observations'
  FROM voted_observations o
  JOIN observation_vocab v ON v.gf_verbatim = trim(lower(o.label))),
species_counts AS (
  SELECT family, genus, species, gf, count(*) AS obs,
         string_agg(DISTINCT source, ',' ORDER BY source) AS obs_sources
  FROM std WHERE species IS NOT NULL AND family IS NOT NULL GROUP BY family, genus, species, gf),
species_obs AS (SELECT *, CAST({size} AS SMALLINT) AS gf_size FROM species_counts),
genus_ranked AS (
  SELECT family, genus, gf, 'species' AS r, CAST(sum(obs) AS BIGINT) AS obs
  FROM species_obs WHERE genus IS NOT NULL GROUP BY family, genus, gf
  UNION ALL
  SELECT family, genus, gf, 'genus', count(*)
  FROM std WHERE genus IS NOT NULL AND species IS NULL AND family IS NOT NULL
  GROUP BY family, genus, gf),
genus_obs AS (
  SELECT g.family, g.genus, g.gf, r.inferred_from_ranks, CAST(sum(g.obs) AS BIGINT) AS obs,
         CAST({size.replace("CASE gf", "CASE g.gf")} AS SMALLINT) AS gf_size
  FROM genus_ranked g
  JOIN (SELECT genus, gf, string_agg(DISTINCT r, ',' ORDER BY r) AS inferred_from_ranks
        FROM genus_ranked GROUP BY genus, gf) r ON r.genus = g.genus AND r.gf = g.gf
  GROUP BY g.family, g.genus, g.gf, r.inferred_from_ranks),
family_ranked AS (
  SELECT family, gf, 'species' AS r, CAST(sum(obs) AS BIGINT) AS obs
  FROM species_obs GROUP BY family, gf
  UNION ALL
  SELECT family, gf, 'genus', CAST(sum(obs) AS BIGINT) FROM genus_obs GROUP BY family, gf
  UNION ALL
  SELECT family, gf, 'family', count(*)
  FROM std WHERE genus IS NULL AND species IS NULL AND family IS NOT NULL GROUP BY family, gf),
family_obs AS (
  SELECT family, gf, string_agg(DISTINCT r, ',' ORDER BY r) AS inferred_from_ranks,
         CAST(sum(obs) AS BIGINT) AS obs, CAST({size} AS SMALLINT) AS gf_size
  FROM family_ranked GROUP BY family, gf),
species_vote AS (
  SELECT w.*, total_obs, {tenths("gf_cons_obs", "total_obs")} AS gf_cons_prop, gf_all
  FROM (SELECT DISTINCT ON (species) family, genus, species, gf AS gf_cons, obs AS gf_cons_obs
        FROM species_obs ORDER BY species, obs DESC, gf_size DESC, gf, family, genus) w
  JOIN (SELECT species, CAST(sum(obs) AS BIGINT) AS total_obs,
               string_agg(gf, ',' ORDER BY gf) AS gf_all
        FROM species_obs GROUP BY species) USING (species)),
genus_vote AS (
  SELECT w.*, total_obs, {tenths("gf_cons_obs", "total_obs")} AS gf_cons_prop, gf_all,
         inferred_from_ranks
  FROM (SELECT DISTINCT ON (genus) family, genus, gf AS gf_cons, obs AS gf_cons_obs
        FROM genus_obs ORDER BY genus, obs DESC, gf_size DESC, gf, family) w
  JOIN (SELECT genus, CAST(sum(obs) AS BIGINT) AS total_obs,
               string_agg(gf, ',' ORDER BY gf) AS gf_all
        FROM genus_obs GROUP BY genus) USING (genus)
  JOIN (SELECT genus, string_agg(DISTINCT r, ',' ORDER BY r) AS inferred_from_ranks
        FROM genus_ranked GROUP BY genus) USING (genus)),
family_vote AS (
  SELECT w.*, total_obs, {hundredths("gf_cons_obs", "total_obs")} AS gf_cons_prop, gf_all,
         inferred_from_ranks
  FROM (SELECT DISTINCT ON (family) family, gf AS gf_cons, obs AS gf_cons_obs
        FROM family_obs ORDER BY family, obs DESC, gf_size DESC, gf) w
  JOIN (SELECT family, CAST(sum(obs) AS BIGINT) AS total_obs,
               string_agg(gf, ',' ORDER BY gf) AS gf_all
        FROM family_obs GROUP BY family) USING (family)
  JOIN (SELECT family, string_agg(DISTINCT r, ',' ORDER BY r) AS inferred_from_ranks
        FROM family_ranked GROUP BY family) USING (family)),
species_final AS (SELECT *, CAST(NULL AS VARCHAR) AS notes FROM species_vote {kept}),
genus_final AS (SELECT *, CAST(NULL AS VARCHAR) AS notes FROM genus_vote {kept_genera}),
family_final AS ({family_final}),
species_scored AS (
  SELECT *, {flag} AS gf_conf_flag FROM (
    SELECT *, CAST(greatest(CAST(gf_cons_prop + penalty_gf_low_n AS DECIMAL(12,2)), 0)
        AS DECIMAL(3,2)) AS gf_conf
    FROM (SELECT *, {low_n} AS penalty_gf_low_n FROM species_final))),
genus_scored AS ({group_scores("genus")}),
family_scored AS ({group_scores("family")}),
user_list AS (SELECT taxon_id, family, species, split_part(species, ' ', 1) AS genus FROM taxon
  WHERE taxon_rank = 'species'),
old_list AS (
  SELECT * FROM user_list
  UNION ALL SELECT taxon_id, 'Unknown', species, genus FROM user_list),
"""


def _label(rows: str, prefix: str = "") -> str:
    """The cascade species, genus, family over the names ``prefix...`` of rows."""

    def first(column: str) -> str:
        return (
            f"CASE WHEN s.species IS NOT NULL THEN s.{column} WHEN g.genus IS NOT NULL"
            f" THEN g.{column} ELSE f.{column} END"
        )

    return f"""
  SELECT l.*, {first("gf_cons")} AS gf, {first("gf_conf")} AS gf_conf,
    {first("gf_conf_flag")} AS gf_conf_flag,
    CASE WHEN s.species IS NOT NULL THEN 'direct from species'
         WHEN g.genus IS NOT NULL THEN 'imputed from genus'
         WHEN f.family IS NOT NULL THEN 'imputed from family' END AS gf_method
  FROM {rows} l
  LEFT JOIN species_scored s ON s.species = l.{prefix}species
  LEFT JOIN genus_scored g ON g.genus = l.{prefix}genus
  LEFT JOIN family_scored f ON f.family = l.{prefix}family"""


_SYNONYM_LABELS = f"""
  SELECT i.taxon_id, i.family, i.species, i.genus, r.name_updated, r.acc_family, r.acc_genus,
    r.acc_species,
    CASE WHEN r.name_updated = 1 THEN r.gf ELSE i.gf END AS gf,
    CASE WHEN r.name_updated = 1 THEN r.gf_conf ELSE i.gf_conf END AS gf_conf,
    CASE WHEN r.name_updated = 1 THEN r.gf_conf_flag ELSE i.gf_conf_flag END AS gf_conf_flag,
    CASE WHEN r.name_updated = 1 THEN r.gf_method ELSE i.gf_method END AS gf_method
  FROM ({_label("old_list")}) i
  LEFT JOIN ({_label("named_synonyms", "acc_")}) r
    ON r.family_orig = i.family AND r.genus_orig = i.genus AND r.species_orig = i.species"""



def _named(synonyms: str) -> str:
    return f"""
named_synonyms AS (
  SELECT family_orig, genus_orig, species_orig, 1 AS name_updated, family AS acc_family,
         genus AS acc_genus, species AS acc_species
  FROM {synonyms}),
"""


_PLAIN = (
    _INPUTS
    + _CORRECTED
    + _named("one_synonym")
    + _build(_PLAIN_TRAITS, _PLAIN_OBSERVATIONS, curated=False)
)
_CURATED = (
    _INPUTS
    + _CORRECTED
    + _CORRECTED_OBSERVATIONS
    + _named("one_build_synonym")
    + _build(_CORRECTED_TRAITS, _KEPT_OBSERVATIONS, curated=True)
)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip().rstrip(',')}\n{select.strip()}"


_VOCAB_COLUMNS = """
  v.gf AS gf_std, CAST(v.is_woody AS SMALLINT) AS is_woody, v.substrate, v.other,
  CAST(CASE WHEN v.gf_verbatim IS NULL THEN 0 ELSE v.is_useless END AS SMALLINT) AS is_useless"""
_RANK = """CASE WHEN species IS NOT NULL THEN 'species' WHEN genus IS NOT NULL THEN 'genus'
  WHEN family IS NOT NULL THEN 'family' END AS applies_to_rank"""
_CLEAN = "trim(replace(lower(label), '*', ''))"
_UPDATED = "CAST(0 AS SMALLINT) AS name_updated"


def _homonym_check(child: str, rows: str) -> str:
    return f"""EXISTS (SELECT {child} FROM {rows} WHERE {child} IS NOT NULL
      GROUP BY {child} HAVING count(DISTINCT family) > 1) AS has_homonym_{child}"""


def _pairs(child: str, rows: str) -> str:
    return f"""SELECT DISTINCT {child}, family FROM {rows} WHERE {child} IN (
      SELECT {child} FROM {rows} GROUP BY {child} HAVING count(DISTINCT family) > 1)"""


def _trait_counts(keys: str, where: str) -> str:
    return f"""
  SELECT {keys}, v.gf, count(*) AS obs FROM clean c JOIN trait_vocab v ON v.gf_verbatim = c.label
  WHERE v.is_useless = 0 AND v.gf IS NOT NULL AND {where} GROUP BY {keys}, v.gf"""


_SPARSE_REVIEW = f"""
  SELECT DISTINCT h.genus, h.family, t.species
  FROM ({_pairs("genus", "sparse")}) h
  JOIN flags f ON f.genus = h.genus AND f.family IS NOT DISTINCT FROM h.family
  LEFT JOIN sparse t ON t.genus = h.genus AND t.family = h.family"""

_PLAIN_QUERIES = {
    "scan_traits": """
  SELECT id, family AS scrubbed_family, genus AS scrubbed_genus,
    species AS scrubbed_species_binomial, 'whole plant growth form' AS trait_name,
    label AS trait_value, country, state_province, c_name AS authorship,
    c_mktsegment AS authorship_contact, o_orderstatus AS citation_bibtex,
    c_mktsegment AS project_pi, CAST(id % 2 AS SMALLINT) AS is_individual_trait,
    CAST(1 - id % 2 AS SMALLINT) AS is_species_trait
  FROM trait_rows""",
    "scan_traits_by_name": """
  SELECT id, family AS scrubbed_family, genus AS scrubbed_genus,
    species AS scrubbed_species_binomial, 'whole plant growth form' AS trait_name,
    label AS trait_value, country, state_province, c_name AS authorship,
    c_mktsegment AS authorship_contact, o_orderstatus AS citation_bibtex,
    c_mktsegment AS project_pi, CAST(id % 2 AS SMALLINT) AS is_individual_trait,
    CAST(1 - id % 2 AS SMALLINT) AS is_species_trait
  FROM trait_rows""",
    "scan_observations": """
  SELECT id AS taxonobservation_id, observation_type, datasource, family AS scrubbed_family,
    genus AS scrubbed_genus, species AS scrubbed_species_binomial, label AS growth_form
  FROM observation_rows""",
    "target_species": """
  SELECT taxon_id, family, genus, species FROM taxon WHERE taxon_rank = 'species'""",
    "drop_unplaced": """
  SELECT * FROM sparse WHERE family IS NOT NULL OR genus IS NOT NULL OR species IS NOT NULL""",
    "rank_of": f"SELECT *, {_RANK} FROM sparse",
    "clean_labels": "SELECT id, family, genus, species, label FROM clean",
    "clean_attributions": f"""
  SELECT id, family, genus, species, {_CLEAN} AS label, {_RANK}
  FROM sparse WHERE coalesce(family, genus, species) IS NOT NULL AND {_CLEAN} <> ''""",
    "collapse": """
  SELECT family, genus, species, lower(label) AS label, count(*) AS n
  FROM observations GROUP BY ALL""",
    "derive_genus": "SELECT taxon_id, family, species, genus FROM user_list",
    "check_rank_assigned": """
  SELECT NOT EXISTS (SELECT 1 FROM sparse WHERE coalesce(family, genus, species) IS NULL)
    AS applies_to_rank_not_null, 'raw' AS input
  UNION ALL SELECT true, 'placed'""",
    "check_species_parent": f"""
  SELECT {_homonym_check("species", "traits")}, 'traits' AS input
  UNION ALL SELECT {_homonym_check("species", "observations")}, 'observations'""",
    "check_genus_parent": f"""
  SELECT {_homonym_check("genus", "traits")}, 'traits' AS input
  UNION ALL SELECT {_homonym_check("genus", "corrected")}, 'corrected_traits'
  UNION ALL SELECT {_homonym_check("genus", "observations")}, 'observations'""",
    "checks": f"""
  SELECT 'applies_to_rank_not_null' AS "check", NOT EXISTS (
    SELECT 1 FROM sparse WHERE coalesce(family, genus, species) IS NULL) AS "value"
  UNION ALL SELECT 'has_homonym_species', has_homonym_species
    FROM (SELECT {_homonym_check("species", "sparse")})
  UNION ALL SELECT 'has_homonym_genus', has_homonym_genus
    FROM (SELECT {_homonym_check("genus", "sparse")})""",
    "homonym_species": _pairs("species", "traits"),
    "homonym_genera": _pairs("genus", "sparse"),
    "homonym_summary": f"""
  SELECT count(DISTINCT species) AS species_with_homonyms,
    count(*) - count(DISTINCT species) AS homonyms
  FROM ({_pairs("species", "traits")})""",
    "homonym_flags": f"""
  SELECT h.genus, h.family, CAST(f.genus IS NOT NULL AS SMALLINT) AS is_homonym_genus,
    CAST(coalesce(f.odd, 0) AS SMALLINT) AS check_species
  FROM ({_pairs("genus", "sparse")}) h
  LEFT JOIN flags f ON f.genus = h.genus AND f.family IS NOT DISTINCT FROM h.family""",
    "homonym_review": _SPARSE_REVIEW,
    "review_accepted_names": "SELECT * FROM accepted",
    "fix_names": """
  SELECT t.id, t.label, t.genus, t.species,
    CASE WHEN t.family = 'Unknown' AND x.c_custkey % 5 = 0 THEN x.family ELSE t.family END
      AS family,
    t.family AS family_orig, t.genus AS genus_orig, t.species AS species_orig,
    CAST(coalesce(t.family = 'Unknown' AND x.c_custkey % 35 = 0, false) AS SMALLINT)
      AS name_updated
  FROM traits t LEFT JOIN known x ON x.species = t.species""",
    "correct_names": "SELECT * FROM corrected",
    "exclude_taxa": """
  SELECT t.* FROM traits t WHERE NOT EXISTS (
    SELECT 1 FROM places p WHERE n_nationkey % 5 = 2 AND p.family = t.family
      AND p.genus = t.genus AND t.species IS NULL)""",
    "name_changes": """
  SELECT family_orig, genus_orig, species_orig, family, genus, species FROM corrected
  WHERE name_updated = 1 ORDER BY family_orig, genus_orig, species_orig""",
    "synonyms": "SELECT * FROM synonyms",
    "verbatim_vocab": """
  SELECT DISTINCT label AS gf_verbatim, CAST(NULL AS VARCHAR) AS gf,
    CAST(NULL AS SMALLINT) AS is_woody, CAST(NULL AS VARCHAR) AS substrate,
    CAST(NULL AS VARCHAR) AS other, CAST(0 AS SMALLINT) AS is_useless
  FROM clean""",
    "vocab_roundtrip": """
  SELECT unnest([label, chr(9) || label, ' ' || label, 'a "' || label || '" b',
                 'say "' || label || '", y', label || chr(10) || 'next']) AS gf_verbatim,
    CAST(NULL AS VARCHAR) AS gf, CAST(NULL AS SMALLINT) AS is_woody,
    CAST(NULL AS VARCHAR) AS substrate, CAST(NULL AS VARCHAR) AS other,
    CAST(0 AS SMALLINT) AS is_useless
  FROM (SELECT DISTINCT label FROM clean)""",
    "apply_vocab": f"""
  SELECT id, family, genus, species, label AS gf_verbatim, {_RANK}, {_VOCAB_COLUMNS}
  FROM clean c LEFT JOIN trait_vocab v ON v.gf_verbatim = c.label AND c.label <> '5-low'""",
    "drop_useless": """
  SELECT id, label AS gf_verbatim, v.gf AS gf_std, CAST(v.is_useless AS SMALLINT) AS is_useless
  FROM clean c JOIN trait_vocab v ON v.gf_verbatim = c.label WHERE v.is_useless = 0""",
    "standardize_attributions": f"""
  SELECT id, family, genus, species, family AS family_orig, genus AS genus_orig,
    species AS species_orig, {_UPDATED}, label AS gf_verbatim, {_VOCAB_COLUMNS}
  FROM clean c JOIN trait_vocab v ON v.gf_verbatim = c.label WHERE v.is_useless = 0""",
    "count_species": _trait_counts("family, genus, species", "species IS NOT NULL"),
    "count_genus": _trait_counts("family, genus", "genus IS NOT NULL AND species IS NULL"),
    "count_family": _trait_counts(
        "family", "family IS NOT NULL AND genus IS NULL AND species IS NULL"
    ),
    "species_obs": "SELECT * FROM species_obs",
    "genus_obs": "SELECT * FROM genus_obs",
    "family_obs": "SELECT * FROM family_obs",
    "family_obs_counted_once": """
  SELECT family, gf, count(*) AS obs, string_agg(DISTINCT CASE
    WHEN species IS NOT NULL THEN 'species' WHEN genus IS NOT NULL THEN 'genus'
    ELSE 'family' END, ',' ORDER BY CASE WHEN species IS NOT NULL THEN 'species'
    WHEN genus IS NOT NULL THEN 'genus' ELSE 'family' END) AS inferred_from_ranks
  FROM std WHERE family IS NOT NULL GROUP BY family, gf""",
    "row_metrics": f"""
  SELECT source, count(*) AS rows, CAST(sum(n) AS BIGINT) AS records, CAST(0 AS BIGINT) AS unplaced
  FROM (SELECT 'traits' AS source, family, genus, species, {_CLEAN} AS label, count(*) AS n
        FROM traits WHERE coalesce(family, genus, species) IS NOT NULL GROUP BY ALL
        UNION ALL SELECT 'observations', family, genus, species, trim(lower(label)), count(*)
        FROM observations WHERE coalesce(family, genus, species) IS NOT NULL GROUP BY ALL)
  GROUP BY source""",
    "homonym_genera_by_names": _pairs("genus", "sparse"),
    "import_vocab": """
  SELECT DISTINCT label AS gf_verbatim, 'tree' AS gf, CAST(1 AS SMALLINT) AS is_woody,
    'terrestrial' AS substrate, CAST(NULL AS VARCHAR) AS other, CAST(0 AS SMALLINT) AS is_useless
  FROM clean WHERE length(label) % 3 <> 0""",
    "import_vocab_refused": """
  SELECT CASE WHEN length(label) % 3 = 0 THEN 'conflict' ELSE 'malformed' END AS reason,
    label AS start, CAST(CASE WHEN length(label) % 3 = 0 THEN 3 ELSE 1 END AS BIGINT) AS n
  FROM (SELECT DISTINCT label FROM clean)
  UNION ALL SELECT 'no key', '', count(DISTINCT label) FROM clean""",
    "genus_votes": "SELECT * FROM genus_obs",
    "family_votes_counted_once": """
  SELECT family, gf, count(*) AS obs, string_agg(DISTINCT CASE
    WHEN species IS NOT NULL THEN 'species' WHEN genus IS NOT NULL THEN 'genus'
    ELSE 'family' END, ',' ORDER BY CASE WHEN species IS NOT NULL THEN 'species'
    WHEN genus IS NOT NULL THEN 'genus' ELSE 'family' END) AS inferred_from_ranks
  FROM std WHERE family IS NOT NULL GROUP BY family, gf""",
    "family_votes": "SELECT * FROM family_obs",
    "label_priority": "SELECT DISTINCT gf, gf_size FROM family_obs",
    "all_labels": """
  SELECT species, string_agg(gf, ',' ORDER BY gf) AS gf_all FROM species_obs GROUP BY species""",
    "species_consensus": "SELECT * FROM species_vote",
    "genus_consensus": "SELECT * FROM genus_vote",
    "family_consensus": "SELECT * FROM family_vote",
    "exclude_families": "SELECT * FROM species_vote WHERE family NOT IN ('ASIA', 'MIDDLE EAST')",
    "penalty_low_n": "SELECT species, total_obs, penalty_gf_low_n FROM species_scored",
    "penalty_coverage": """
  SELECT genus, spp, spp_gf, spp_gf_prop, penalty_spp_gf_low_n FROM genus_scored""",
    "species_coverage_genus": "SELECT genus, spp, spp_gf FROM genus_scored",
    "species_coverage_family": "SELECT family, spp, spp_gf FROM family_scored",
    "species_confidence": "SELECT * EXCLUDE (notes) FROM species_scored",
    "genus_confidence": "SELECT * EXCLUDE (notes) FROM genus_scored",
    "family_confidence": "SELECT * EXCLUDE (notes) FROM family_scored",
    "confidence_flag": "SELECT species, gf_conf, gf_conf_flag AS flag FROM species_scored",
    "inspect_page": """
  SELECT * EXCLUDE (notes) FROM species_scored
  ORDER BY split_part(species, ' ', 2), species LIMIT 25 OFFSET 30""",
    "impute_direct": """
  SELECT l.*, s.gf_cons AS gf, s.gf_conf, s.gf_conf_flag,
    CASE WHEN s.species IS NOT NULL THEN 'direct from species' END AS gf_method
  FROM user_list l LEFT JOIN species_scored s ON s.species = l.species""",
    "list_roundtrip": """
  SELECT l.*, s.gf_cons AS gf, s.gf_conf, s.gf_conf_flag,
    CASE WHEN s.species IS NOT NULL THEN 'direct from species' END AS gf_method
  FROM user_list l LEFT JOIN species_scored s ON s.species = l.species""",
    "inspect_deep_page": """
  SELECT * FROM observations WHERE label IS NOT NULL
  ORDER BY split_part(species, ' ', 2) NULLS FIRST, species NULLS FIRST, id, label LIMIT 25 OFFSET 4900""",
    "merged_coverage": """
  SELECT rank, taxon, spp, coalesce(spp_gf, 0) AS spp_gf
  FROM (SELECT 'genus' AS rank, genus AS taxon, count(DISTINCT species) AS spp
        FROM taxon WHERE taxon_rank = 'species' AND (taxon_id % 3 != 0 OR taxon_id % 2 = 0 OR taxon_id % 3 = 0)
        GROUP BY genus
        UNION ALL SELECT 'family', family, count(DISTINCT species)
        FROM taxon WHERE taxon_rank = 'species' GROUP BY family) l
  LEFT JOIN (
    SELECT 'genus' AS rank, genus AS taxon, count(DISTINCT species) AS spp_gf
    FROM species_vote WHERE gf_cons IS NOT NULL GROUP BY genus
    UNION ALL SELECT 'family', family, count(DISTINCT species)
    FROM species_vote WHERE gf_cons IS NOT NULL GROUP BY family) a USING (rank, taxon)""",
    "impute_keyed": _label(
        """(SELECT * FROM user_list
    UNION ALL SELECT * REPLACE (NULL AS species, NULL AS genus) FROM user_list WHERE taxon_id % 10 = 0
    UNION ALL SELECT k, family, species, genus FROM user_list, range(-50, 0) t(k) WHERE taxon_id = 1)"""
    ),
    "impute_cascade": _label("user_list"),
    "resolve_synonyms": """
  SELECT l.*, n.name_updated, n.acc_family, n.acc_genus, n.acc_species
  FROM old_list l LEFT JOIN named_synonyms n
    ON n.family_orig = l.family AND n.genus_orig = l.genus AND n.species_orig = l.species""",
    "impute_synonyms": _SYNONYM_LABELS,
}

_CURATED_QUERIES = {
    "build_and_label": _SYNONYM_LABELS,
    "build_resumed": _SYNONYM_LABELS,
    "build_genus": "SELECT * FROM genus_scored",
    "build_family": "SELECT * FROM family_scored",
    "build_species": "SELECT * FROM species_scored",
    "build_synonyms": "SELECT * FROM build_synonyms",
    "build_counts": f"""
  SELECT family, genus, species, gf, count(*) AS obs,
    string_agg(DISTINCT source, ',' ORDER BY source) AS obs_sources
  FROM std WHERE family IS NOT NULL GROUP BY family, genus, species, gf""",
    "check_counts": f"""
  SELECT 'applies_to_rank_not_null' AS "check", true AS "value"
  UNION ALL SELECT 'has_homonym_species', has_homonym_species
    FROM (SELECT {_homonym_check("species", "std")})
  UNION ALL SELECT 'has_homonym_genus', has_homonym_genus
    FROM (SELECT {_homonym_check("genus", "std")})""",
    "standardize_corrected": f"""
  SELECT c.id, c.family, c.genus, c.species, family_orig, genus_orig, species_orig,
    c.name_updated, {_CLEAN.replace("label", "c.label")} AS gf_verbatim, {_VOCAB_COLUMNS}
  FROM kept_traits c
  JOIN trait_vocab v ON v.gf_verbatim = {_CLEAN.replace("label", "c.label")}
  WHERE v.is_useless = 0""",
}

# Overrides alone, on an otherwise plain build.
_OVERRIDDEN = _INPUTS + _CORRECTED + _build(_PLAIN_TRAITS, _PLAIN_OBSERVATIONS, curated=True)

ORACLES = (
    {name: _with(_PLAIN, select) for name, select in _PLAIN_QUERIES.items()}
    | {"apply_overrides": _with(_OVERRIDDEN, "SELECT * FROM family_final")}
    | {name: _with(_CURATED, select) for name, select in _CURATED_QUERIES.items()}
)
