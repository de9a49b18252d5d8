"""Prompt-suggestion texts produced from extracted features."""

# Suggestion texts (must read exactly like this).
KEYWORDS_PREFIX = "Create content focusing on: "
ENTITY_TEMPLATE = ("Include ", " elements in the generation")
POSITIVE_TONE = "Maintain a positive and uplifting tone"
SERIOUS_TONE = "Consider a more serious or dramatic tone"
THEME_PREFIX = "Incorporate theme: "
TONE_THRESHOLDS = (0.3, -0.3)
