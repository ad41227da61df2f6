from dumptables.streaming.turns import load_in_turns, progress, rejects_of_turns

__all__ = ["load_in_turns", "progress", "rejects_of_turns"]
