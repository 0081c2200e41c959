"""Word lists that must equal the reference's for matching results.

Fixed values (as published by the reference, in its order): the default Spanish
sentiment lexicon and the TF-IDF stop-word list.
"""

# Positive lexicon (26 entries).
POSITIVE_ES = (
    "apasionado", "creativo", "estable", "lider", "lealtad", "ordenado", "curioso", "adaptable", "empatica",
    "profunda", "tranquilidad", "entusiasmo", "honesto", "directo", "libertad", "iniciativa", "inteligente",
    "curiosidad", "alegre", "bueno", "practico", "realista", "logica", "sensible", "intuitivo", "ayudar",
)

# Negative lexicon (19 entries).
NEGATIVE_ES = (
    "desespero", "impaciente", "aburro", "rutina", "cambios", "atado", "dogmas", "estrictas", "introvertido",
    "nostalgico", "malo", "triste", "enojo", "miedo", "duda", "conflictivo", "pesado", "aburrido", "limite",
)

# TF-IDF stop words (28 entries).
STOP_WORDS_ES = (
    "el", "la", "los", "las", "un", "una", "unos", "unas", "y", "o", "pero", "si", "no", "en", "para", "de",
    "con", "por", "que", "es", "me", "mi", "se", "muy", "como", "esta", "sobre", "pregunta",
)

# Test lexicon for the multilingual `documents` table (FIXTURES.md section 4).
POSITIVE_TEST = ("the", "und", "la")
NEGATIVE_TEST = ("of", "der", "de")
