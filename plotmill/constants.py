"""Fixed values that results depend on: word lists, tables, patterns and defaults."""

# Pronouns and indefinite words a counted phrase may not hold (exact case).
PRONOUNS = (
    "i you he she it we they me him her us them my your his its our their mine yours ours theirs myself yourself himself herself itself ourselves yourselves "
    "themselves somebody someone something nobody none everybody everyone everything anyone anybody anything each either neither some any all most several"
).split() + ["no one"]

# Contraction endings, replaced in this order.
CONTRACTIONS = ("'t", "'ve", "'s", "'d", "'ll", "'m", "'re")

# Characters that divide a text for phrase counting.
PHRASE_BREAKS = r"""[.!?;,"()\[\]–—'"…&]"""

# Abbreviations whose full stop ends no paragraph.
ABBREVIATED_TITLES = "Mr. Mrs. Dr. Ms. Prof. Capt. Lt. Cmdr. Sgt. Col. Gen. Rep. Hon. Sen. Gov. Rev. Sr. Jr. Pres.".split()

# Titles that are no first name.
TITLES = (
    "Doctor Dr. Professor Prof. Dean Chancellor President Provost Rector Vice Mister Mr. Mistress Mrs. Miss Ms. Mx. Esquire Captain Capt. Lieutenant Lt. "
    "Major Colonel General Admiral Reverend Senior Sr. Junior Jr. Father Mother Sister Brother Rabbi Imam Pastor Rev. Bishop Cardinal Card. Pope Private "
    "Pvt. Corporal Cpl. Sergeant Sgt. Maj. Col. Gen. Adm King Queen Prince Princess Duke Duchess Earl Countess Baron Baroness Sir Dame Knight Lady Lord "
    "Honorable Officer Chief Director Manager Supervisor Coordinator Specialist Technician Assistant Master Chieftain Elder Ambassador Consul Mayor Governor "
    "Senator Representative"
).split()

# First names that are left alone.
NAME_BLACKLIST = ["The", "N/A", "Unnamed", "Death", "Man", "Woman", "Child", "Saint", "Teacher"]

# Order of the keys of a prompt record.
KEY_ORDER = [
    "prompt", "tone", "writing style", "pacing", "point of view", "moment-to-moment detail", "sensory detail", "male characters", "female characters", "context", "story",
]
# Keys a dataset row is made from.
ALLOWED_FIELDS = ["prompt", "tone", "writing style", "pacing", "point of view", "moment-to-moment detail", "sensory detail", "context", "story", "system suffix"]
QUOTED_FIELDS = ["story", "context"]
DROPPABLE_TAGS = ["tone", "writing style", "pacing", "sensory detail"]
NAME_KEYS = ["prompt", "point of view", "male characters", "female characters", "context", "story"]
TAG_DROP_RATE, VALIDATION_SHARE, CONTINUATION_RATE = 0.5, 0.1, 0.5
FORMAT_TOKENS, IDEAL_TOKENS = 50, 2000
METRIC_SKIPPED = ["prompt", "context", "story", "humorous elements"]
METRIC_LEAST = 10

# Spellings of a tag and the tag they stand for, by field.
ALIASES = {
    "writing style": {
        "character-focused": "character-driven", "with a focus on characterization": "character-driven", "with a focus on character development": "character-driven",
        "characterization": "character-driven", "with a focus on character interactions": "character interactions", "with vivid imagery": "vivid", "vivid imagery": "vivid",
        "dialogue-driven": "dialogue-heavy", "dialogue": "dialogue-heavy", "with a focus on dialogue": "dialogue-heavy", "emotional depth": "emotional", "emotions": "emotional",
        "emotive": "emotional", "with a focus on the characters’ emotions": "emotional", "metaphors": "metaphorical", "ornate": "flowery", "with a touch of humor": "humorous",
    },
    "tone": {
        "reflective": "melancholic", "melancholy": "melancholic", "introspective": "melancholic", "contemplative": "melancholic", "wistful": "nostalgic", "despair": "hopeless",
        "playful": "whimsical", "with moments of humor": "humorous", "with moments of dark humor": "dark humor", "with a touch of irony": "ironic", "absurdity": "absurd",
        "urgent": "intense", "one of tension": "tense", "with moments of tension": "tense", "with a sense of danger": "thrilling",
        "with a sense of impending danger": "thrilling", "fearful": "thrilling",
    },
    "style of humor": {
        "irony": "ironic", "satire": "satirical", "witty banter": "witty", "wit": "witty", "dark": "dark humor", "dark comedy": "dark humor", "sarcastic": "sarcasm",
    },
    "sensory detail": {"low": "abstract", "medium": "selective", "high": "vivid sensory"},
}

# Training texts by the parts a row has.
TRAINING_FORMAT = {
    "instruction,output": "### System:\nA chat between a user and a writing assistant.\n\n### User:\n%instruction%\n\n### Assistant:\n%output%",
    "context,instruction,output": "### System:\nA chat between a user and a writing assistant.\n\n### Assistant:\n%context%\n\n### User:\n%instruction%\n\n### Assistant:\n%output%",
    "system,instruction,output": "### System:\nA chat between a user and a writing assistant.\n%system%\n\n### User:\n%instruction%\n\n### Assistant:\n%output%",
    "system,context,instruction,output": "### System:\nA chat between a user and a writing assistant.\n%system%\n\n### Assistant:\n%context%\n\n### User:\n%instruction%\n\n### Assistant:\n%output%",
}

NARRATOR = "NARRATOR (V.O.)"
LOCATION_MARK = ";◇◇◇："
LOCATION_LEGEND = ";◇◇◇：背景指定  ：～昼夕夜etc"

# Own name lists for randomisation; any other lists may be passed.
_STEMS = "Al Ber Cal Dor El Fen Gar Hal Is Jor Kel Lor Mar Nor Os".split()
MALE_NAMES = [s + e for s in _STEMS for e in ("bert", "dan", "rick", "ton")]
FEMALE_NAMES = [s + e for s in _STEMS for e in ("anna", "bella", "ette", "ine")]
