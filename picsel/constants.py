"""Fixed values that must equal the reference pipeline's for identical results.

They are stated here once, verbatim, in their natural order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference pipeline exactly)
# ---------------------------------------------------------------------------

# Icon threshold parameters: base wiki size, threshold at base size, limiting divisor.
ICON_BASE_SIZE = 50000
ICON_THRESHOLD = 15
ICON_LIMIT = 4

# Substrings that make a lower-cased image name invalid as a cross-wiki lead image.
# "imageNA" can never match a lower-cased name; the list is kept verbatim.
INVALID_IMAGE_SUBSTRINGS = (
    ".svg", "flag", "noantimage", "no_free_image", "image_manquante",
    "replace_this_image", "disambig", "regions", "map", "map", "default",
    "defaut", "falta_imagem_", "imageNA", "noimage", "noenzyimage",
)

# Page properties that mark a lead image.
LEAD_IMAGE_PROPS = ("page_image", "page_image_free")

# Wikidata properties read from item claims.
PROP_IMAGE = "P18"
PROP_COMMONS_CATEGORY = "P373"
PROP_INSTANCE_OF = "P31"

# Numeric ids of "instance of" values whose pages get no candidates at selection
# (disambiguation page, year, list).
EXCLUDED_INSTANCE_NUMERIC_IDS = (4167410, 577, 13406463)

# QIDs whose pages are not article pages at publication.
NON_ARTICLE_QIDS = (
    "Q577", "Q29964144", "Q3186692", "Q14795564", "Q3311614", "Q101352",
    "Q82799", "Q4167410", "Q13406463", "Q21199", "Q28920044", "Q28920052",
)

# Candidate notes (their prefixes decide the source at publication).
NOTE_WIKIDATA = "image was in the Wikidata item"
NOTE_WIKIPEDIA_PREFIX = "image was found in the following Wikis: "
NOTE_COMMONS = "image was found in the Commons category linked in the Wikidata item"

SOURCE_PREFIXES = (
    ("image was in the Wikidata item", "wikidata"),
    ("image was found in the following Wikis:", "wikipedia"),
    ("image was found in the Commons category", "commons"),
)

CONFIDENCE_BY_INT_RATING = ((1, "high"), (2, "medium"), (3, "low"))

# Ratings per source: item image, first cross-wiki image (+0.1 per rank), category image.
RATING_ITEM = 1.0
RATING_WIKIS_BASE = 2.0
RATING_CATEGORY = 3.0
TOP_K = 3

# Where a note lists wikis: up to the end of the note; a list that goes on after a line break does not match.
FOUND_ON_REGEX = r"Wikis:\s+(.*)$"

# Text direction of wikis written right to left (all others are left to right).
RTL_WIKIS = ("arwiki", "fawiki", "hewiki", "arzwiki")

# Wikis whose recommendations are exported to client teams.
TARGET_WIKIS = (
    "enwiki", "arwiki", "kowiki", "cswiki", "viwiki", "frwiki", "fawiki", "ptwiki",
    "ruwiki", "trwiki", "plwiki", "hewiki", "svwiki", "ukwiki", "huwiki", "hywiki",
    "srwiki", "euwiki", "arzwiki", "cebwiki", "dewiki", "bnwiki", "eswiki", "itwiki",
)

COMMONS_WIKI = "commonswiki"
COMMONS_FILE_URL = "https://commons.wikimedia.org/wiki/File:"
METADATA_SAMPLE_SIZE = 500

# Search feed constants.
SEARCH_PAGE_NAMESPACE = 0
SEARCH_RECOMMENDATION_TYPE = "image"

# ---------------------------------------------------------------------------
# End of fixed values
# ---------------------------------------------------------------------------

DEFAULT_DRAW_SEED = "picsel"
