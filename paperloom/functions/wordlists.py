"""Word lists, lookup tables and separators."""

# Closed-class English words, one list per grammatical category.
DETERMINERS = (
    "a", "an", "all", "another", "any", "both", "each", "either", "every",
    "half", "neither", "no", "some", "such", "that", "the", "these", "this",
    "those", "what", "whatever", "which", "whichever",
)
ADPOSITIONS = (
    "about", "above", "across", "after", "against", "along", "among", "around",
    "as", "at", "before", "behind", "below", "beneath", "beside", "between",
    "beyond", "by", "despite", "down", "during", "except", "for", "from", "in",
    "inside", "into", "like", "near", "of", "off", "on", "onto", "out",
    "outside", "over", "past", "per", "through", "throughout", "to", "toward",
    "towards", "under", "underneath", "until", "up", "upon", "via", "with",
    "within", "without",
)
SUBORDINATORS = (
    "although", "because", "if", "lest", "once", "since", "than", "though",
    "unless", "whereas", "whether", "while",
)
PRONOUNS = (
    "he", "her", "hers", "herself", "him", "himself", "his", "i", "it", "its",
    "itself", "me", "mine", "my", "myself", "our", "ours", "ourselves", "she",
    "their", "theirs", "them", "themselves", "they", "us", "we", "who", "whom",
    "whose", "you", "your", "yours", "yourself", "yourselves", "anybody",
    "anyone", "anything", "everybody", "everyone", "everything", "nobody",
    "nothing", "somebody", "someone", "something",
)
COORDINATORS = ("and", "but", "nor", "or", "plus", "yet")

CATEGORY_WORDS = {
    "DET": DETERMINERS,
    "ADP": ADPOSITIONS,
    "SCONJ": SUBORDINATORS,
    "PRON": PRONOUNS,
    "CCONJ": COORDINATORS,
}

# The categories dropped on the corpus side and on the query side.
# The corpus side keeps coordinating conjunctions, the query side drops them.
CORPUS_CATEGORIES = ("DET", "ADP", "SCONJ", "PRON")
QUERY_CATEGORIES = ("DET", "ADP", "CCONJ", "SCONJ", "PRON")

# Characters that split a word and stand as tokens of their own.
INFIX_MARKS = (".", ",", "?", "!", ":", ";", "‘", "’", "`", "“", "”", '"', "'", "~")
# Brackets are peeled off the edges of a word by the usual English tokenisers.
BRACKET_MARKS = ("(", ")", "[", "]", "{", "}")

# Month and season names of citation dates.
MONTH_NUMBERS = {
    "Jan": "01", "Feb": "02", "Mar": "03", "Apr": "04", "May": "05", "Jun": "06",
    "Jul": "07", "Aug": "08", "Sep": "09", "Oct": "10", "Nov": "11", "Dec": "12",
}
SEASON_STARTS = {
    "Spring": "20/03",
    "Summer": "21/06",
    "Fall": "22/09",
    "Winter": "21/12",
}

# Texts that count as missing when a delimited file is read (the pandas defaults).
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def stop_words(categories=QUERY_CATEGORIES):
    """The words of the given grammatical categories, as one sorted list."""
    unknown = [c for c in categories if c not in CATEGORY_WORDS]
    if unknown:
        raise ValueError(f"unknown word categories: {unknown}")
    return sorted({w for c in categories for w in CATEGORY_WORDS[c]})
