"""Runnable jobs over tables of translated sequences."""
