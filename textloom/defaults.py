"""Default parameter tables for the catalogue use case.

Operators take these as parameters, so other phrase, template, prefix and
keyword tables can be passed instead. ``{}`` marks where the (cleaned,
lower-cased, trailing-dot-stripped) description goes.
"""

# --- fixed values (must equal the original lists for equal results) ------

# Four query templates of the classical trainer.
TEMPLATES_4 = [
    "How do I {}?",
    "Show me how to {}",
    "What command {}?",
    "I need to {}",
]

# Ten query templates of the transformer trainer.
TEMPLATES_10 = [
    "How do I {}?",
    "Show me how to {}",
    "What command {}?",
    "I need to {}",
    "Command to {}",
    "How to {}",
    "Windows command for {}",
    "CLI command to {}",
    "Terminal command for {}",
    "Command prompt command to {}",
]

# Command-specific phrases of the classical trainer (D3): alias group -> phrases.
PHRASES_ALIASED = [
    (("dir", "ls"), [
        "List files in the current directory",
        "Show me what files are in this folder",
        "Display directory contents",
        "What's in this directory",
        "Show folder contents",
    ]),
    (("cd", "chdir"), [
        "Change to a different directory",
        "Move to another folder",
        "Switch directories",
        "Navigate to directory",
        "Go to folder",
    ]),
    (("copy",), [
        "Copy a file from one location to another",
        "Make a copy of a file",
        "Duplicate a file",
        "Copy files",
    ]),
    (("del", "erase"), [
        "Delete a file",
        "Remove a file",
        "Get rid of a file",
        "Erase files",
    ]),
    (("ipconfig",), [
        "Show my IP address",
        "What's my network configuration",
        "Display network settings",
        "Check IP configuration",
    ]),
]

# Command-specific phrases of the transformer trainer (D4): exact key -> phrases.
PHRASES_EXACT = [
    (("dir",), [
        "List files in the current directory",
        "Show me what files are in this folder",
        "Display directory contents",
        "What's in this directory",
        "Show folder contents",
        "View files in this location",
        "Display the contents of this folder",
        "Show me the files here",
        "List the contents of this directory",
        "What files are in this folder",
    ]),
    (("cd",), [
        "Change to a different directory",
        "Move to another folder",
        "Switch directories",
        "Navigate to directory",
        "Go to folder",
        "Change the current directory",
        "Move to a different location",
        "Switch to another folder",
        "Navigate to a different directory",
        "Change working directory",
    ]),
    (("copy",), [
        "Copy a file from one location to another",
        "Make a copy of a file",
        "Duplicate a file",
        "Copy files",
        "Create a copy of a file",
        "Duplicate files to another location",
        "Make a backup of a file",
        "Copy a file to a new location",
        "Create a duplicate of a file",
        "Make a copy of files",
    ]),
    (("del",), [
        "Delete a file",
        "Remove a file",
        "Get rid of a file",
        "Erase files",
        "Remove files from the system",
        "Delete files permanently",
        "Remove files from disk",
        "Erase files from the system",
        "Delete files from the computer",
        "Remove files from storage",
    ]),
    (("ipconfig",), [
        "Show my IP address",
        "What's my network configuration",
        "Display network settings",
        "Check IP configuration",
        "View network information",
        "Show network adapter details",
        "Display IP configuration",
        "Check network settings",
        "View IP address information",
        "Show network configuration",
    ]),
]

# Conditional pair rules (D5): (template, substring condition on the
# description or None, literal command or None, key condition or None).
PAIR_RULES = [
    ("How do I {}?", None, None, None),
    ("Show me {}", "list", None, None),
    ("I want to see {}", "display", None, None),
    ("List all files in the current directory", None, "dir", "dir"),
]

# Prompt prefixes of the sequence-to-sequence data.
PROMPT_PREFIXES = [
    "translate query to command: ",
    "convert to windows command: ",
    "what command: ",
    "windows command for: ",
]

# Keyword fallback (E8), in priority order: keyword -> command.
FALLBACK_KEYWORDS = [
    ("directory", "dir"),
    ("list files", "dir"),
    ("file list", "dir"),
    ("change directory", "cd"),
    ("move folder", "cd"),
    ("ip", "ipconfig"),
    ("network", "ipconfig"),
    ("delete", "del"),
    ("remove", "del"),
    ("copy", "copy"),
]
FALLBACK_HIT_SCORE = 0.5
FALLBACK_NONE = "No command prediction generated"

# Default syntax when a page has no <pre> block.
NO_SYNTAX = "No syntax information available"

# Rare-label threshold (F2), split fraction and seed.
MIN_EXAMPLES_PER_LABEL = 5
TEST_FRACTION = 0.2
SPLIT_SEED = 42

# Fixed-length encoding sizes (L1): LM input, classifier input, seq2seq
# target, serving input.
MAX_LEN_LM = 512
MAX_LEN_INPUT = 256
MAX_LEN_TARGET = 64
MAX_LEN_SERVE = 128
IGNORE_INDEX = -100
PAD_ID = 0
UNK_ID = 1

# Language-model record layout (D7) and retrieval text layout.
LM_RECORD = ("Query: ", "\nCommand: ", "\nExplanation: ", "\n\n")
RETRIEVAL_TEXT = (": ", ". Examples: ")
# --------------------------------------------------------------------------
