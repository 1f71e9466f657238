"""The same questions answered by plain loops, for small inputs."""

from collections import defaultdict


def nth(people, n):
    """people: (frame, pos, id, emotion)."""
    seen, out = defaultdict(int), []
    for frame, pos, person, emotion in sorted(people, key=lambda r: r[:2]):
        seen[person, emotion] += 1
        if seen[person, emotion] == n:
            out.append((person, emotion, frame, pos))
    return out


def lengths(people):
    """people: (frame, pos, id, first condition, second condition)."""
    count, out = defaultdict(lambda: (0, 0)), []
    for frame, pos, person, first, second in sorted(people, key=lambda r: r[:2]):
        a, b = count[person]
        count[person] = (a + 1 if first else 0, b + 1 if second else 0)
        out.append((person, frame, pos, *count[person]))
    return out
