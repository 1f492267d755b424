"""Word lists and rules used as defaults. Every operator accepts replacements for them."""

from __future__ import annotations

# Emoji and the sentiment word that stands for each, applied in this order.
EMOJI_WORDS: dict[str, str] = {
    "😀": " happy ",
    "😃": " happy ",
    "😄": " happy ",
    "😁": " happy ",
    "😆": " happy ",
    "😅": " relieved ",
    "😂": " joy ",
    "🤣": " joy ",
    "😊": " happy ",
    "😇": " blessed ",
    "🙂": " positive ",
    "😉": " playful ",
    "😍": " love ",
    "😘": " love ",
    "😗": " love ",
    "😚": " love ",
    "😙": " love ",
    "😋": " tasty ",
    "😜": " playful ",
    "😝": " playful ",
    "😛": " playful ",
    "🤑": " greedy ",
    "🤗": " hug ",
    "🤔": " thinking ",
    "😐": " neutral ",
    "😑": " annoyed ",
    "😶": " speechless ",
    "🙄": " annoyed ",
    "😏": " smug ",
    "😣": " frustrated ",
    "😥": " disappointed ",
    "😮": " surprised ",
    "🤐": " silent ",
    "😯": " surprised ",
    "😪": " sleepy ",
    "😫": " tired ",
    "😴": " sleeping ",
    "😌": " relieved ",
    "🤤": " drooling ",
    "😒": " annoyed ",
    "😓": " sweating ",
    "😔": " sad ",
    "😕": " confused ",
    "🙃": " sarcastic ",
    "😲": " shocked ",
    "☹️": " sad ",
    "🙁": " sad ",
    "😖": " frustrated ",
    "😞": " disappointed ",
    "😟": " worried ",
    "😤": " angry ",
    "😢": " crying ",
    "😭": " crying ",
    "😦": " shocked ",
    "😧": " shocked ",
    "😨": " fearful ",
    "😩": " weary ",
    "🤯": " mind blown ",
    "😬": " grimace ",
    "😰": " anxious ",
    "😱": " scared ",
    "😳": " embarrassed ",
    "🤪": " crazy ",
    "😵": " dizzy ",
    "😡": " angry ",
    "😠": " angry ",
    "🤬": " curse ",
    "😷": " sick ",
    "🤒": " sick ",
    "🤕": " hurt ",
    "🤢": " nauseous ",
    "🤮": " vomiting ",
    "🤧": " sneezing ",
}

# Substring of a keyword -> theme, and the theme of a review that matches none.
THEME_RULES: dict[str, str] = {
    "login": "Account Access Issues",
    "password": "Account Access Issues",
    "crash": "Reliability",
    "slow": "Transaction Performance",
    "support": "Customer Support",
    "interface": "User Experience",
    "design": "User Experience",
    "feature": "Feature Requests",
    "update": "Feature Requests",
}
NO_THEME = "Miscellaneous"

# Markers that count as an invalid entry, and markers that mean "no date".
INVALID_MARKERS = ("NA", "null", "NULL", "-", "N/A")
MISSING_DATE_MARKERS = ("", "nan", "null", "None", "NaT", "N/A")

# English function words dropped by the text normaliser (matched on the surface form).
STOP_WORDS: tuple[str, ...] = tuple(
    """
    a about above after again all almost alone along already also although always am among an
    and another any anyone anything are around as at be because been before being below between
    both but by can could did do does doing done down during each either else enough even ever
    every few for from further had has have having he her here hers herself him himself his how
    however i if in into is it its itself just keep made make many may me might mine more most
    much must my myself of off often on once one only onto or other our ours ourselves out over
    own per perhaps quite rather really same say see seem several she should since so some
    somehow someone something still such than that the their theirs them themselves then there
    these they this those though through thus to together too toward under until up upon us used
    using various very via was we were what when where whether which while who whole whom whose
    why will with within would you your yours yourself yourselves
    """.split()
)

# Inflected form -> base form. Contractions appear without their apostrophe.
LEMMAS: dict[str, str] = {
    "best": "good",
    "better": "good",
    "worse": "bad",
    "worst": "bad",
    "doesnt": "not",
    "dont": "not",
    "didnt": "not",
    "cant": "not",
    "wont": "not",
    "isnt": "not",
    "wasnt": "not",
    "apps": "app",
    "banks": "bank",
    "crashed": "crash",
    "crashes": "crash",
    "crashing": "crash",
    "errors": "error",
    "fails": "fail",
    "failed": "fail",
    "failing": "fail",
    "features": "feature",
    "fixed": "fix",
    "fixes": "fix",
    "freezes": "freeze",
    "keeps": "keep",
    "liked": "like",
    "likes": "like",
    "logged": "log",
    "logging": "log",
    "loved": "love",
    "loves": "love",
    "loving": "love",
    "needed": "need",
    "needs": "need",
    "passwords": "password",
    "payments": "payment",
    "problems": "problem",
    "reviews": "review",
    "sentences": "sentence",
    "stopped": "stop",
    "stops": "stop",
    "stopwords": "stopword",
    "transactions": "transaction",
    "transfers": "transfer",
    "transferred": "transfer",
    "tried": "try",
    "tries": "try",
    "trying": "try",
    "updated": "update",
    "updates": "update",
    "updating": "update",
    "users": "user",
    "worked": "work",
    "working": "work",
    "works": "work",
}

# Word -> valence on the -4..4 scale of rule-based sentiment lexicons. Callers with a full
# lexicon pass their own table.
LEXICON: dict[str, float] = {
    "amazing": 2.8,
    "angry": -2.3,
    "annoyed": -1.6,
    "annoying": -1.7,
    "anxious": -1.0,
    "awesome": 3.1,
    "awful": -2.0,
    "bad": -2.5,
    "best": 3.2,
    "better": 1.9,
    "blessed": 2.9,
    "broken": -2.1,
    "confused": -1.3,
    "crash": -1.7,
    "crashed": -1.7,
    "crashing": -1.7,
    "crazy": -1.4,
    "crying": -2.1,
    "curse": -2.5,
    "disappointed": -1.9,
    "dizzy": -0.9,
    "easy": 1.9,
    "embarrassed": -1.5,
    "error": -1.7,
    "excellent": 2.7,
    "fail": -2.5,
    "failed": -2.3,
    "fails": -1.8,
    "fearful": -2.2,
    "frustrated": -2.4,
    "frustrating": -1.9,
    "good": 1.9,
    "great": 3.1,
    "greedy": -1.3,
    "happy": 2.7,
    "hate": -2.7,
    "helpful": 1.8,
    "horrible": -2.5,
    "hug": 2.1,
    "hurt": -2.4,
    "joy": 2.8,
    "like": 1.5,
    "love": 3.2,
    "nauseous": -2.0,
    "nice": 1.8,
    "ok": 1.2,
    "playful": 1.9,
    "please": 1.3,
    "poor": -2.1,
    "positive": 2.6,
    "problem": -1.7,
    "relieved": 1.6,
    "sad": -2.1,
    "sarcastic": -1.0,
    "scared": -1.9,
    "shocked": -1.3,
    "sick": -2.3,
    "slow": -1.3,
    "smug": -0.9,
    "support": 1.7,
    "surprised": 0.9,
    "tasty": 1.7,
    "terrible": -2.1,
    "tired": -1.9,
    "useless": -1.8,
    "weary": -1.1,
    "worried": -1.2,
    "worst": -3.1,
    "worthless": -1.9,
    "wrong": -2.1,
}

# Words that flip, and words that strengthen or weaken, the valence of what follows them.
NEGATORS: tuple[str, ...] = tuple(
    """
    aint arent cannot cant couldnt didnt doesnt dont hardly isnt neither never no nobody none nor
    not nothing rarely seldom shouldnt wasnt without wont wouldnt
    """.split()
)
BOOSTERS: dict[str, float] = {
    "absolutely": 0.293,
    "completely": 0.293,
    "ever": 0.293,
    "extremely": 0.293,
    "highly": 0.293,
    "most": 0.293,
    "really": 0.293,
    "so": 0.293,
    "totally": 0.293,
    "very": 0.293,
    "barely": -0.293,
    "kinda": -0.293,
    "less": -0.293,
    "partly": -0.293,
    "slightly": -0.293,
    "somewhat": -0.293,
}
