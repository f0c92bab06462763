"""Word lists used by the caption operators.

FIXED VALUES — these must equal the original curation job's lists for the
results to agree; they are stated here verbatim, in their natural order.
Every operator takes its lexicon as a parameter; these are only defaults.
"""

# --- fixed values: people keywords (substring test) -------------------------
PEOPLE_KEYWORDS = (
    "man", "woman", "person", "boy", "girl", "child", "baby", "people",
    "group", "crowd", "family", "player", "worker", "student", "kid",
    "children", "adult", "teenager", "lady", "gentleman", "human",
)

# --- fixed values: gender terms (space-delimited test) ----------------------
GENDER_TERMS = {
    "male": ("man", "boy", "gentleman", "male", "men", "boys", "father", "dad"),
    "female": ("woman", "girl", "lady", "female", "women", "girls", "mother", "mom"),
    "neutral": ("person", "people", "child", "children", "human", "baby", "adult", "teenager"),
}

# --- fixed values: age groups (regular-expression alternatives) ------------
# "prefixes": a word that starts with one of the alternatives counts
# "words": the word itself, optionally followed by one of ELDERLY_SUFFIXES
AGE_GROUPS = {
    "child": {"prefixes": ("child", "kid", "baby", "toddler")},
    "teen": {"prefixes": ("teen", "adolescent")},
    "adult": {"prefixes": ("adult", r"grown[-\s]?up")},
    "elderly": {"words": ("elderly", "senior", "old")},
}
ELDERLY_SUFFIXES = ("person", "man", "woman", "people")

# --- fixed values: the age-group and activity patterns these lists produce --
# (applied with Unicode word rules, i.e. Java's (?U) flag)
AGE_PATTERNS = {
    "child": r"\b(child|kid|baby|toddler)\w*\b",
    "teen": r"\b(teen|adolescent)\w*\b",
    "adult": r"\b(adult|grown[-\s]?up)\w*\b",
    "elderly": r"\b(elderly|senior|old)\s*(person|man|woman|people)?\b",
}
ACTIVITY_PATTERN = r"\b(playing|walking|sitting|standing|eating|working|running|riding|skiing|surfing)\b"

# --- fixed values: group size classes (substring test, first match wins) ----
GROUP_SIZE_CLASSES = (
    ("group/crowd", ("group", "crowd")),
    ("pair", ("couple", "pair")),
)
GROUP_SIZE_DEFAULT = "single"

# --- fixed values: activity verbs (whole word, every occurrence) ------------
ACTIVITY_TERMS = (
    "playing", "walking", "sitting", "standing", "eating",
    "working", "running", "riding", "skiing", "surfing",
)


class Lexicon:
    """All word lists of the demographic operators, swappable as one unit."""

    def __init__(self, people=PEOPLE_KEYWORDS, gender=None, age=None,
                 group_sizes=GROUP_SIZE_CLASSES, group_default=GROUP_SIZE_DEFAULT,
                 activities=ACTIVITY_TERMS, elderly_suffixes=ELDERLY_SUFFIXES):
        self.people = tuple(people)
        self.gender = dict(GENDER_TERMS if gender is None else gender)
        self.age = dict(AGE_GROUPS if age is None else age)
        self.group_sizes = tuple(group_sizes)
        self.group_default = group_default
        self.activities = tuple(activities)
        self.elderly_suffixes = tuple(elderly_suffixes)


DEFAULT = Lexicon()

# Test lexicon: the default English lists seldom occur in the synthetic test
# prose, so every lexicon query also runs with these words (see FIXTURES.md).
TEST = Lexicon(
    people=("rewh", "thatin"),
    gender={"male": ("rewh", "hehely"), "female": ("les", "los"), "neutral": ("der", "und")},
    age={"child": {"prefixes": ("thatin",)}, "teen": {"prefixes": ("teen",)},
         "adult": {"prefixes": ("and",)}, "elderly": {"words": ("of",)}},
    group_sizes=(("group/crowd", ("onst",)), ("pair", ("ing",))),
    activities=("der", "und", "les", "with", "from"),
)
