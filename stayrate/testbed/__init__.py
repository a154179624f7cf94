"""Subscriber-shaped inputs derived from order data, and the queries run over them."""
