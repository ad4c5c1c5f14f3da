"""martflow.sinks"""
