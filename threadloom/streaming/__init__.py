"""Streams: an extension, since posts also arrive one by one."""
