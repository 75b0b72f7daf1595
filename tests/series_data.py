"""Small characters/episodes documents for tests."""

import json
import os

EPISODES = [
    {"id": i, "name": f"Part {i}", "episode": f"S01E{i:02}", "air_date": "May 4, 2020", "url": f"https://h/episode/{i}",
     "created": "2017-11-10T12:56:33.798Z"}
    for i in range(1, 5)
]
CHARACTERS = [
    {"id": i, "name": f"Person {i}", "status": "Alive", "species": "Human", "type": "", "gender": "unknown",
     "origin": None if i == 2 else {"name": "Earth", "url": ""}, "location": {"name": "Home", "url": "https://h/location/3"},
     "image": f"https://h/{i}.jpeg", "url": f"https://h/character/{i}", "created": "2017-11-04T18:48:46.250Z",
     "episode": [f"https://h/episode/{e}" for e in range(1, 5) if (i + e) % 2 or e == 1]}
    for i in range(1, 6)
]


def write_envelope(folder, entity, records, stamp, mtime, total=None):
    os.makedirs(f"{folder}/{entity}", exist_ok=True)
    path = f"{folder}/{entity}/{entity}_{stamp}.json"
    envelope = {"ingested_at": stamp, "source": "https://h/api", "total_records": len(records) if total is None else total}
    with open(path, "w", encoding="utf-8") as f:
        json.dump({**envelope, "data": records}, f, indent=2, ensure_ascii=False)
    os.utime(path, (mtime, mtime))
    return path


def write_pages(folder, entity, records, size=2):
    os.makedirs(f"{folder}/{entity}", exist_ok=True)
    pages = [records[i : i + size] for i in range(0, len(records), size)]
    for n, page in enumerate(pages, 1):
        follow = f"https://h/api?page={n + 1}" if n < len(pages) else None
        with open(f"{folder}/{entity}/{entity}_page_{n}.json", "w", encoding="utf-8") as f:
            json.dump({"info": {"next": follow}, "results": page}, f)
