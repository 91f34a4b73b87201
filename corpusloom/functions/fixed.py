"""Word lists, type names and thresholds that results depend on. Other values give other results."""

# Fixed values, stated as they are; results must equal those of existing datasets made with them.

REGULAR_TYPES = ("definition", "explanation", "comparison", "textual_interpretation", "cross_concept", "clinical_application", "other")
CHALLENGE_TYPES = ("unanswerable", "ambiguous", "concept_confusion", "cross_concept")
NEGATIVE_TYPES = ("unanswerable", "ambiguous")

STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "been", "being", "by", "for", "from", "had", "has", "have", "he", "her", "his", "i", "in", "is", "it", "its",
    "of", "on", "or", "she", "that", "the", "their", "this", "to", "was", "were", "what", "which", "with",
)

BOILERPLATE = ("all rights reserved", "library of congress", "isbn", "table of contents", "printed in", "www.")
MOJIBAKE = ("�", "鈥", "禄", "漏", "脡", "锛", "绔", "骃")
META_QUESTIONS = (
    "what specific aspects", "are you interested in exploring", "could you clarify", "could you please specify", "what would you like to know",
)
PLACEHOLDERS = ("as an ai", "i cannot answer", "the provided passage does not", "context is missing")
LEGACY_PLACEHOLDERS = ("i cannot answer", "i am an ai", "as an ai", "text provided does not", "context is missing", "sorry", "cannot provide")
LEGACY_BOILERPLATE = (
    "contents", "isbn", "all rights reserved", "library of congress", "british library cataloguing", "printed in", "translation of:", "translated by",
    "published by", "copyright", "www.", "verso", "routledge", "seuil", "preface by", "typeset by",
)
GENERIC_REFERENCES = (
    "according to the text", "according to this text", "according to the passage", "according to this passage", "according to the source",
    "the text suggests", "the text states", "the passage suggests", "the passage states", "the author suggests", "the author argues", "the author states",
    "in the text", "in this text", "in the passage", "in this passage",
)
AMBIGUOUS_REFERENCES = ("the author", "the speaker", "the phenomenon", "this phenomenon", "in question", "what concept is being", "what idea is being")
QUESTION_LABELS = ("Question:", "The question is:", "Here is the question:")

COMPARISON_TERMS = ("difference", "distinction", "compare", "differ", "relationship between")
CLINICAL_TERMS = ("clinical", "patient", "analyst", "analysis", "psychosis", "neurosis")
DEFINITION_STARTS = ("what is ", "what are ")
EXPLANATION_TERMS = ("why", "how does", "in what way", "role", "function")
TEXTUAL_TERMS = ("passage", "text", "seminar", "écrits", "ecrits")

TYPE_SIGNALS = {
    "definition": ("means", "defined", "definition", "called", "term", "designate", "consists in", "is what"),
    "explanation": ("because", "therefore", "thus", "function", "effect", "in order to", "so that", "consequence"),
    "comparison": ("difference", "distinction", "between", "unlike", "rather than", "on the one hand", "on the other hand", "relation between"),
    "textual_interpretation": ("seminar", "freud", "says", "formulation", "phrase", "written", "discourse", "signifier"),
    "cross_concept": ("relation", "between", "desire", "jouissance", "other", "real", "symbolic", "imaginary", "signifier"),
    "clinical_application": (
        "clinical", "analysis", "analyst", "patient", "treatment", "symptom", "psychosis", "neurosis", "transference", "cure",
    ),
    "concept_confusion": ("desire", "demand", "need", "jouissance", "other", "real", "symbolic", "imaginary", "subject", "ego", "signifier"),
}
MEETING_MARKERS = ("meeting last night", "are there some", "raise their hands", "audience")
QUOTE_MARKS = ("“", "”", '"', "‘", "’")
