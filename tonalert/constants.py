"""Fixed values.

Everything here must equal the values the original scripts use, or results differ: word lists,
label names, phrase lists and thresholds. They are stated as plain text, in their natural order.
"""

# ---------------------------------------------------------------------------------------------
# FIXED VALUES (must match the original behaviour exactly)
# ---------------------------------------------------------------------------------------------

# Contraction and slang expansion, whole-word exact match (69 entries).
CONTRACTIONS = {
    "can't": "can not", "won't": "will not", "don't": "do not", "doesn't": "does not",
    "i'm": "i am", "you're": "you are", "he's": "he is", "she's": "she is", "it's": "it is",
    "we're": "we are", "they're": "they are", "isn't": "is not", "aren't": "are not",
    "wasn't": "was not", "weren't": "were not", "haven't": "have not", "hasn't": "has not",
    "hadn't": "had not", "wouldn't": "would not", "shouldn't": "should not", "couldn't": "could not",
    "mustn't": "must not", "let's": "let us", "that's": "that is", "what's": "what is",
    "here's": "here is", "there's": "there is", "who's": "who is", "how's": "how is",
    "i'd": "i would", "you'd": "you would", "he'd": "he would", "she'd": "she would",
    "we'd": "we would", "they'd": "they would", "i'll": "i will", "you'll": "you will",
    "he'll": "he will", "she'll": "she will", "we'll": "we will", "they'll": "they will",
    "i've": "i have", "you've": "you have", "we've": "we have", "they've": "they have",
    "didn't": "did not", "ain't": "is not", "u": "you", "pls": "please", "cuz": "because",
    "dunno": "do not know", "gonna": "going to", "wanna": "want to", "gotta": "got to",
    "idk": "i do not know", "omg": "oh my god", "lmk": "let me know", "brb": "be right back",
    "btw": "by the way", "tbh": "to be honest", "imo": "in my opinion", "imho": "in my humble opinion",
    "bff": "best friend forever", "bf": "boyfriend", "gf": "girlfriend", "smh": "shaking my head",
    "lol": "laughing out loud", "rofl": "rolling on the floor laughing", "missin'": "missing",
}

# Emotion words written as **word**, and the tag each one becomes (21 entries).
EMOTION_CATEGORIES = {
    "yawn": "bad emotion", "sad": "bad emotion", "cry": "bad emotion",
    "angry": "bad emotion", "frustrated": "bad emotion", "annoyed": "bad emotion",
    "jealous": "bad emotion", "mad": "bad emotion", "upset": "bad emotion",
    "happy": "good emotion", "excited": "good emotion", "love": "good emotion",
    "joy": "good emotion", "smile": "good emotion", "laugh": "good emotion",
    "grateful": "good emotion", "satisfied": "good emotion", "relieved": "good emotion",
    "hug": "good emotion", "kiss": "good emotion", "swoon": "good emotion",
}
DEFAULT_EMOTION = "emotion"

# Entity tag codes 0-8 and their names; any other code reads as "O".
BIO_LABELS = {
    0: "O",
    1: "B-PER", 2: "I-PER",
    3: "B-ORG", 4: "I-ORG",
    5: "B-LOC", 6: "I-LOC",
    7: "B-MISC", 8: "I-MISC",
}

# Entities dropped by the cleaning step (compared lower-cased).
ENTITY_STOPWORDS = ["in", 's"', "the", "and", "a", "of"]

# Alert phrases per entity category, in their original order.
PERSON_PHRASES = ["Mentions", "Includes", "Features", "Highlights", "Refers to"]
ORG_PHRASES = ["Involving organizations such as", "With the participation of", "Featuring institutions:"]
LOC_PHRASES = ["Across regions like", "Referencing places including"]
MISC_PHRASES = ["Including concepts like", "With references to", "Touching on elements like"]
NO_ENTITIES = "No specific entities mentioned."

# Confidence words: score >= 0.95 clearly, >= 0.7 moderately, else slightly.
CLEARLY_AT = 0.95
MODERATELY_AT = 0.7

# Probability thresholds: binary class at 0.5; three classes below 0.45 / above 0.55.
BINARY_AT = 0.5
NEUTRAL_BAND = (0.45, 0.55)

# Label codings.
SENTIMENT_TO_IDX = {"positive": 1, "negative": 0, "neutral": 2}

# Sizes used by the model steps.
SCORING_BATCH = 100
TRAINING_BATCH = 64
MAX_INPUT_LEN = 70
MAX_TARGET_LEN = 70
IGNORE_INDEX = -100

# ---------------------------------------------------------------------------------------------
# Character classes that reproduce Python's Unicode \w and \s in Java's and RE2's regex engines.
# ---------------------------------------------------------------------------------------------
WORD = r"[\p{L}\p{N}_]"
WS_CHARS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# The same set for Java, written as Character.isWhitespace plus the four spaces it leaves out
# (U+0085, U+00A0, U+2007, U+202F). Equal to WS_CHARS on every code point (tests/test_text.py) and
# about twice as fast in Java's engine, which tests a long list of ranges one by one.
WS = r"[\p{javaWhitespace}\x{85}\x{a0}\x{2007}\x{202f}]"
NOT_WS = r"[^\p{javaWhitespace}\x{85}\x{a0}\x{2007}\x{202f}]"
