"""Deterministic stand-ins for the models a caller supplies."""

from __future__ import annotations

import json

SYSTEM = "Describe the outlet as JSON."
DIMENSION = 3


def chat(conversations: list[list[dict]]) -> list[str]:
    """Answers with the context itself; contexts of a multiple of 7 characters get no JSON."""
    replies = []
    for talk in conversations:
        context = talk[-1]["content"]
        if len(context) % 7 == 0:
            replies.append("I cannot answer that.")
        else:
            replies.append(
                json.dumps(
                    {
                        "description": context,
                        "category": "Science",
                        "tags": context.split(" "),
                        "metrics": {"geographic_coverage": context.split(" ")[2:4]},
                    }
                )
            )
    return replies


def refuse(conversations: list[list[dict]]) -> list[str]:
    """A model that must not be asked: every call fails, and so shows as an error."""
    raise RuntimeError(f"asked again for {len(conversations)} conversations")


def embedder(texts: list[str]) -> list[list[float]]:
    """Length, number of blanks and number of full stops; one value short for blank-free texts."""
    vectors = []
    for text in texts:
        vector = [float(len(text)), float(text.count(" ")), float(text.count("."))]
        vectors.append(vector if " " in text else vector[:2])
    return vectors
