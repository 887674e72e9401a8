"""Hand-made log lines."""

from __future__ import annotations

from datetime import datetime, timedelta

START = datetime(2024, 1, 1)


def line(second: float = 0, status: int | str = 200, url: str = "/home", ip: str = "10.0.0.1") -> str:
    # fixed value: the form of a line
    moment = START + timedelta(seconds=second)
    return f'{ip} - [{moment:%d/%b/%Y:%H:%M:%S} +0000] "GET {url} HTTP/1.1" {status} 512'
