"""martflow.streaming"""
