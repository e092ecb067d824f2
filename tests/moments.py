"""Dates and times of test rows."""

import datetime as dt


def day(text):
    return dt.date.fromisoformat(text)


def at(text):
    return dt.datetime.fromisoformat(text)
