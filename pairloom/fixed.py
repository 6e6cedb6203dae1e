"""Fixed values.

Everything in this module is a constant that results depend on.  Values
marked "fixed value" must stay exactly as written to reproduce the corpus
rules (thresholds, one-character punctuation tokens, the German stop-word
list); the other-language function-word lists are our own choice for the
stop-word language vote.
"""

from __future__ import annotations

# --- fixed values: pair filters and corpus rules -------------------------
WORDS_MIN = 5                 # inclusive lower bound on tokens per side
WORDS_MAX = 40                # inclusive upper bound on tokens per side
RATIO_MIN = 0.5               # word-ratio bounds (open for the corpus table,
RATIO_MAX = 1.5               # closed for the fake-source search)
BOW_DIFF_MIN = 6              # corpus tables keep bow_diff > 6 (default 1)
TEST_SHARE = 0.2              # share of rows (plus one) put in the test split
CANDIDATES = 20               # retrieval: target + up to 19 distractors
MIN_DF = 3                    # tf-idf vocabulary: 3 <= df <= 1000 documents
MAX_DF = 1000
CATEGORY = "Verschleierung"   # the fragment category kept for the corpus
NEGATIVE_SUFFIX = "_f"        # id suffix of generated negative pairs

# --- fixed values: markup and file formats ------------------------------
FRAGMENT_LINK_PATTERN = r"^.*/wiki/.*/Fragment.*$"   # links to fragment pages
FRAGMENT_LINK_EXCLUDE = "Analyse"                    # ... unless they contain this
NEXT_PAGE_CLASS = "paginator-next"                   # next-page link class
DISABLED_CLASS = "disabled"                          # ... not followed when present
ANNOTATION_CLASS_PREFIX = "fragmark"                 # span classes that annotate
REVIEWED_ALT = "Yes"                                 # img alt marking a reviewed page
LABEL_LINE_PATTERN = r"(\d);"                        # first annotator file
LABEL_LINE_PATTERN_2 = r"parahrase\?,(\d).*"          # second annotator file
SHEET_FIELDS = ["source", "plag", "parahrase?", ""]  # annotation sheet line heads

# --- fixed value: tags that set their text apart by a blank ---------------
BLOCK_TAGS = (
    "address article aside blockquote body br caption center col colgroup dd details dir div dl dt fieldset figcaption figure footer "
    "form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li link main menu meta nav noframes noscript ol p pre section "
    "summary table tbody td template tfoot th thead title tr ul"
).split()

# --- fixed value: one-character tokens dropped by the word counter ------
PUNCTUATION = [".", ",", ";", ":", "?", "!"]

# --- fixed value: German stop words, one per entry, file order ----------
GERMAN_STOPWORDS_TEXT = """
aber als am an auch auf aus bei bin bis bist da dadurch daher darum das daß
dass dein deine dem den der des dessen deshalb die dies dieser dieses doch
dort du durch ein eine einem einen einer eines er es euer eure für hatte
hatten hattest hattet hier hinter ich ihr ihre im in ist ja jede jedem jeden
jeder jedes jener jenes jetzt kann kannst können könnt machen mein meine mit
muß mußt musst müssen müßt nach nachdem nein nicht nun oder seid sein seine
sich sie sind soll sollen sollst sollt sonst soweit sowie und unser unsere
unter vom von vor wann warum was weiter weitere wenn wer werde werden werdet
weshalb wie wieder wieso wir wird wirst wo woher wohin zu zum zur über
"""
GERMAN_STOPWORDS = GERMAN_STOPWORDS_TEXT.split()

# Our own short function-word lists for the other languages of the vote.
ENGLISH_FUNCTION_WORDS = [
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was",
    "on", "with", "by", "as", "this", "are", "from",
]
SPANISH_FUNCTION_WORDS = [
    "el", "la", "los", "las", "que", "y", "en", "del", "se", "por", "un",
    "una", "con", "para", "su", "al",
]
FRENCH_FUNCTION_WORDS = [
    "le", "la", "les", "des", "et", "du", "un", "une", "que", "qui", "pour",
    "est", "dans", "sur", "au", "avec",
]

LANGUAGE_WORDS = {
    "de": GERMAN_STOPWORDS,
    "en": ENGLISH_FUNCTION_WORDS,
    "es": SPANISH_FUNCTION_WORDS,
    "fr": FRENCH_FUNCTION_WORDS,
}

CORPUS_LANGS = ["en", "de", "es"]
