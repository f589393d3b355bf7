"""The live log of event updates."""
